import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tesserae.llm import survivor as m

T0 = datetime(2024, 1, 1)
ENT = "ent_id long, wikidata string, coords string, dateofbirth timestamp_ntz, inception timestamp_ntz, src_class string, modified_at timestamp_ntz, qid string, held int"
TRUST = "src_class string, trust_rank int, n int"


def trust(spark):
    return spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("c", 3, 0)], TRUST)


def test_item_numbers(spark):
    forms = ["http://x/entity/Q12", "wd:Q12", " Q12 ", "http://x/entity/q12", "http://x/wiki/Special:EntityData/Q12.json", "Q１２", "Ｑ０１２", "Q0", "Q", "x", None, "seq12"]
    df = spark.createDataFrame([(f,) for f in forms], "w string")
    assert [r[0] for r in df.select(m.item_key(F.col("w"))).collect()] == ["Q12"] * 7 + ["Q0", None, None, None, None]


def test_points(spark):
    forms = ["Point(1.5 -2)", "Point(1.2E1 3)", "Point(181 0)", "Point(0 91)", "Point(NaN NaN)", "Point()", "Point(1)", "1, 2", "", None]
    df = spark.createDataFrame([(f,) for f in forms], "c string")
    assert [r[0] is not None for r in df.select(m.usable_point(F.col("c"))).collect()] == [True, True] + [False] * 8


def brute(rows, ranks):
    out = set()
    items = {}
    for r in rows:
        items.setdefault(r[1], []).append(r)
    held = lambda r: {i for i in (2, 3, 4) if r[i] is not None}
    for q, rs in items.items():
        union = set().union(*map(held, rs))
        for r in rs:
            others = [o for o in rs if o is not r]
            if others and union and held(r) == union and r[6] and all((o[6] is None or o[6] < r[6]) and ranks.get(o[5], 99) > ranks.get(r[5], 99) for o in others):
                out.add((q, r[0]))
    return out


def test_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, f"Q{rng.randrange(60)}", rng.choice([None, "Point(1 2)"]), rng.choice([None, T0]), rng.choice([None, None, T0]), rng.choice("abcx"), rng.choice([None, *[T0 + timedelta(days=d) for d in range(6)]]), "z", 1) for i in range(150)]
    got = {tuple(r) for r in m.clear_winners(spark.createDataFrame(rows, ENT), trust(spark)).collect()}
    assert got == brute(rows, {"a": 1, "b": 2, "c": 3}) and got


def test_fields_come_from_the_next_layers(spark):
    rows = [(1, "Q1", None, T0, None, "a", T0 + timedelta(2), None, None), (2, "Q1", "Point(1 2)", None, None, "b", T0 + timedelta(1), None, None), (3, "Q1", "Point(3 4)", None, T0, "c", T0, None, None), (4, None, None, None, None, "a", T0, None, None)]
    r = m.best_records(spark.createDataFrame(rows, ENT), trust(spark)).collect()
    assert len(r) == 1 and r[0]["ent_id"] == 3 and (r[0]["from_dateofbirth"], r[0]["from_inception"], r[0]["from_coords"]) == (1, 3, 3) and r[0]["n_rows"] == 3 and not r[0]["clear"]


def test_hot_item_and_empty(spark):
    df = spark.range(20_000).selectExpr("id ent_id", "'Q7' wikidata", "'Point(1 2)' coords", "cast(null as timestamp_ntz) dateofbirth", "cast(null as timestamp_ntz) inception", "if(id = 19999, 'a', 'b') src_class", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) modified_at")
    assert [tuple(r) for r in m.clear_winners(df, trust(spark)).collect()] == [("Q7", 19_999)]
    assert m._reduced(df, trust(spark)).count() == 2
    assert m.best_records(df.limit(0), trust(spark)).collect() == []
