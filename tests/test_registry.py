"""Functions called by name in SQL against the Columns that they are."""

from pyspark.sql import functions as F

from confluo.functions import registry

TEXTS = ["  Ada  Byron ", "ADA@x.org", "no mail", "+44 20 7946 0958", "+1 (415) 555-0132 ext. 9", "Mar 2021", "03/2022", "present", "2022-13", "Springfield, , United States", "GBR", "Côte d'Ivoire", "B.Tech", "Node-JS", "it's 'quoted' \\ and(not) =(x)", "", " ", None]


def test_by_name(spark):
    made = registry.register(spark, "t_")
    assert made == [f"t_{n}" for n in registry.FUNCTIONS]
    rows = spark.createDataFrame([(x, [x, "Languages: PY, Go (9/10)", x], x) for x in TEXTS], "s string, l array<string>, o string")
    rows.createOrReplaceTempView("t_rows")
    for name, f in registry.FUNCTIONS.items():
        args = ["l" if t == registry.LIST else "s" for t in f.takes.values()]
        got = [r[0] for r in spark.sql(f"SELECT t_{name}({', '.join(args)}) FROM t_rows").collect()]
        want = [r[0] for r in rows.select(f.column(spark, *map(F.col, args))).collect()]
        assert got == want, name
    plan = spark.sql("SELECT t_norm_date(s) FROM t_rows")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert registry.listing(spark).count() == len(registry.FUNCTIONS)
