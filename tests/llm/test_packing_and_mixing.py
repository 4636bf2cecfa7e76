import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import mixing, packing, tokens

ITEMS = "doc_id long, n_tokens long, source string, paper_id string"


def check(rows, data, capacity, exclusive=()):
    size = defaultdict(int)
    inside, total = defaultdict(list), defaultdict(int)
    info = {d: (s, p) for d, _, s, p in data}
    for r in rows:
        size[r["container"]] += r["n_tokens"]
        inside[r["container"]].append((r["doc_id"], r["piece"]))
        total[r["doc_id"]] += r["n_tokens"]
    assert max(size.values(), default=0) <= capacity
    assert dict(total) == {d: n or 0 for d, n, _, _ in data}
    for held in inside.values():
        papers = Counter(info[d][1] for d in {d for d, _ in held} if info[d][1] is not None)
        whole = [d for d, _ in held if len([1 for r in rows if r["doc_id"] == d]) == 1]
        assert max(Counter(info[d][1] for d in whole if info[d][1] is not None).values(), default=1) == 1, papers
        s = {info[d][0] for d, _ in held}
        assert not any(a in s and b in s for a, b in exclusive)
    for r in rows:
        n = next(x[1] or 0 for x in data if x[0] == r["doc_id"])
        assert r["n_pieces"] == max(1, -(-n // capacity))
    return len(size)


@pytest.mark.parametrize("shard", [40, 10_000])
def test_containers(spark, shard):
    rnd = random.Random(41)
    data = [(i, rnd.choice([rnd.randrange(1, 100), 0, None, rnd.randrange(100, 350)] + [rnd.randrange(1, 40)] * 4), rnd.choice(["a", "b", "c", None]), rnd.choice([None, "hot", "p1", f"q{i}"])) for i in range(300)]
    df = spark.createDataFrame(data, ITEMS).withColumn("shard", F.lit(1)).withColumn("bin", F.lit("clash"))
    rows = packing.pack(df, capacity=100, exclusive=(("a", "b"),), shard_items=shard).collect()
    check(rows, data, 100, (("a", "b"),))


def test_little_room_is_lost(spark):
    rnd = random.Random(42)
    data = [(i, rnd.randrange(1, 60), "a", None) for i in range(3000)]
    n = packing.pack(spark.createDataFrame(data, ITEMS), capacity=100, shard_items=500).select("container").distinct().count()
    assert n <= 1.02 * sum(d[1] for d in data) / 100 + 1


def test_best_fit_takes_the_tightest_compatible_bin():
    b = packing.Bins(100, {})
    assert [b.place(s, 0, c) for s, c in ((60, "x"), (50, "y"), (40, "x"), (45, None), (30, None))] == [0, 1, 1, 2, 0]
    hot = packing.Bins(100, {})
    assert len({hot.place(10, 0, "same") for _ in range(2000)}) == 2000


def test_no_items(spark):
    assert packing.pack(spark.createDataFrame([], ITEMS)).count() == 0


def mix(spark, docs, targets):
    c, s = mixing.mix_sources(spark.createDataFrame(docs, "doc_id long, source string, n_tokens long").withColumn("h", F.lit(1)).withColumn("cut", F.lit(2)), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    return c.collect(), {r["source"]: r for r in s.collect()}


def test_mix(spark):
    rnd = random.Random(43)
    spell = {"big one": ["big_one", "Big One", "BIG-ONE "], "small": ["small", " Small"], "tiny": ["tiny"]}
    docs = [(i, rnd.choice(spell[k]), rnd.randrange(1, 50)) for i, k in enumerate(["big one"] * 2000 + ["small"] * 300 + ["tiny"] * 20)] + [(9000 + i, None, 10) for i in range(50)] + [(9100, "other", 500), (9101, "small", None)]
    total = sum(n or 0 for _, _, n in docs)
    targets = [("big one", 0.5, 1), ("small", 0.3, 9), ("tiny", 0.1, 2), ("absent", 0.1, 5)]
    copies, shares = mix(spark, docs, targets)
    times = {r["doc_id"]: r["copies"] for r in copies}
    for name, share, most in targets:
        r = shares[name]
        own = [(d, n or 0) for d, s, n in docs if s and s.lower().strip().replace("_", " ").replace("-", " ") == name]
        reach = sum(times.get(d, 0) * n for d, n in own)
        assert reach == r["mix_tokens"] <= share * total and all(times.get(d, 0) <= most for d, _ in own)
        assert r["target_met"] == (sum(n for _, n in own) * most >= int(share * total))
        if r["target_met"]:
            assert reach > share * total - 51
        else:
            assert reach == sum(n for _, n in own) * most
    assert not {d for d, s, _ in docs if s in (None, "other")} & set(times)
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-9


def test_larger_budgets_only_add(spark):
    docs = [(i, "a", 7) for i in range(400)] + [(1000 + i, "b", 7) for i in range(600)]
    one, _ = mix(spark, docs, [("a", 0.1, 3)])
    two, _ = mix(spark, docs, [("a", 0.3, 3)])
    assert {r["doc_id"] for r in one} < {r["doc_id"] for r in two}
    none, shares = mix(spark, [], [("a", 0.1, 3)])
    assert mix(spark, docs, []) == ([], {})
    assert none == [] and shares["a"]["mix_tokens"] == 0 and shares["a"]["actual_share"] is None


def test_token_counts_are_the_tokenizers(spark):
    import os

    path = os.path.join(tokens.TOKENIZERS, tokens.RANKS)
    count = tokens.counter(path)
    texts = ["", "a", " a  b\n\n  c \t d", "don't  stop 12 345 $\\alpha_{12}$ — привет, мир! 你好 世界", "x" * 3000 + " y " + "é " * 50, " \u00a0 \u2003a \u200b b\r\n c", "a\u0085b \u0085 c", "a \x1c b \x1d\x1e c", "trailing space ", "\n a"]
    rnd = random.Random(44)
    texts += ["".join(rnd.choice("ab1'$ \n\té,.я") for _ in range(200)) for _ in range(60)]
    for t in texts:
        assert count.count(t) == len(count.encode(t)), repr(t)
    df = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "doc_id long, text string")
    assert [r["n_tokens"] for r in tokens.with_tokens(df).orderBy("doc_id").collect()] == [2, 0, 0]
