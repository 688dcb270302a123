"""Write an N-times larger copy of the tables the queries read.

Usage: python tools/scale_copy.py SRC_DIR OUT_DIR N
Every copy offsets the primary keys (documents.doc_id, orders.o_orderkey,
lineitem.l_orderkey) so keys stay unique; other columns are unchanged.
Used to check that run time grows linearly with the data.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from tessera.session import local_session  # noqa: E402

KEYS = {"documents": ["doc_id"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey"]}


def main() -> None:
    src, out, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session(cores=8)
    for name, keys in KEYS.items():
        df = spark.read.parquet(f"{src}/{name}.parquet")
        span = df.agg(*[F.max(k) for k in keys]).first()
        offset = max(int(v) for v in span) + 1
        copied = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_copy"))
        big = copied.select(
            *[(F.col(c) + F.col("_copy") * offset).alias(c) if c in keys else F.col(c) for c in df.columns]
        )
        big.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
        print(name, spark.read.parquet(f"{out}/{name}.parquet").count())
    spark.stop()


if __name__ == "__main__":
    main()
