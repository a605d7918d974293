import random

from pyspark.sql import functions as F

from flowlens.functions.time import floor_div
from flowlens.operators import running_agg


def test_running_agg_levels_brute_force(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice("ab"), rnd.randrange(0, 10_000), rnd.randrange(-50, 100)) for i in range(600)]
    df = spark.createDataFrame(data, "id long, p string, o long, v long")
    order = [F.col("o"), F.col("id")]
    for fn in ("sum", "max"):
        for inclusive in (True, False):
            for outer in ([], [floor_div(F.col("o"), 1000)],
                          [floor_div(F.col("o"), 500), floor_div(F.col("o"), 3000)]):
                out = running_agg(df, ["p"], order, F.col("v"), "r", block=floor_div(F.col("o"), 97),
                                  fn=fn, inclusive=inclusive, outer_blocks=outer)
                got = {r["id"]: r["r"] for r in out.collect()}
                exp = {}
                for p in "ab":
                    acc = None
                    for i, _, o, v in sorted((x for x in data if x[1] == p), key=lambda x: (x[2], x[0])):
                        prev = acc
                        acc = v if acc is None else (acc + v if fn == "sum" else max(acc, v))
                        exp[i] = acc if inclusive else (prev if prev is not None else (0 if fn == "sum" else None))
                assert got == exp, (fn, inclusive, len(outer))
