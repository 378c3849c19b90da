"""Compare column types of each Spark key with its DuckDB oracle (type families and widths).

    python scripts/type_check.py [sf_dir]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from cohortkit.plans import catalogue  # noqa: E402
from cohortkit.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK = {"ByteType": "int8", "ShortType": "int16", "IntegerType": "int32", "LongType": "int64",
         "FloatType": "float32", "DoubleType": "float64", "StringType": "string", "BooleanType": "bool",
         "TimestampNTZType": "timestamp", "TimestampType": "timestamp", "DateType": "date"}
DUCK = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "HUGEINT": "int128",
        "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string", "BOOLEAN": "bool",
        "TIMESTAMP": "timestamp", "DATE": "date"}


def spark_type(t) -> str:
    name = type(t).__name__
    if name == "ArrayType":
        return f"list<{spark_type(t.elementType)}>"
    if name == "DecimalType":
        return "decimal"
    return SPARK.get(name, name)


def duck_type(t: str) -> str:
    t = str(t)
    if t.endswith("[]"):
        return f"list<{duck_type(t[:-2])}>"
    if t.startswith("DECIMAL"):
        return "decimal"
    return DUCK.get(t, t)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = catalogue.queries(), catalogue.oracle_sql()
    bad = 0
    for k, sql in sqls.items():
        s = {f.name: spark_type(f.dataType) for f in qs[k](spark, sf_dir).schema.fields}
        rel = con.sql(sql)
        d = {c: duck_type(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (s.get(c), d.get(c)) for c in sorted(set(s) | set(d)) if s.get(c) != d.get(c)}
        if diff:
            bad += 1
            print(k, diff)
    print(f"{len(sqls) - bad}/{len(sqls)} keys with identical column types")


if __name__ == "__main__":
    main()
