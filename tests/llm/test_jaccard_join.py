import random
import re

import pytest
from pyspark.sql import functions as F

from genolake.llm import jaccard_join as J
from genolake.llm.graph import connected_components
from tests.conftest import SF_SMALL


def brute_sets(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [(d, brute_sets(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("token", F.lit(1))
    return sorted(tuple(r) for r in J.near_duplicates(df.repartition(3)).collect())


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choice(vocab) for _ in range(40))
    rows, texts = [], []
    for i in range(120):
        kind = rnd.random()
        if texts and kind < 0.45:
            w = rnd.choice(texts).split()
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 6])):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocab)
            t = " ".join(w)
        elif kind < 0.6:
            t = " ".join(rnd.choice(vocab) for _ in range(30)) + " " + passage
        else:
            t = " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 4, 5, 6, 20, 60, 150])))
        texts.append(t)
        rows.append((i, t.upper() if rnd.random() < 0.1 else t.replace(" ", "\n ", 1)))
    return rows + [(500, None), (501, ""), (502, " \t"), (3, rows[3][1]), (503, "a b"), (504, "A  b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_blocks_and_salts_change_nothing(spark, monkeypatch):
    rows = corpus(5)
    monkeypatch.setattr(J, "MAX_CLUSTER", 7)
    monkeypatch.setattr(J, "shingle_levels", lambda d: (J.np.arange(1 << 21) % 3).astype("uint8"))
    monkeypatch.setattr(J, "FINE_FROM", 20)
    assert run(spark, rows) == brute(rows)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in J.near_duplicates(docs).collect()) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_tree_finds_every_link(monkeypatch):
    monkeypatch.setattr(J, "FINE_FROM", 50)
    rnd = random.Random(3)
    base = [J.np.unique(J.np.array([rnd.getrandbits(64) for _ in range(rnd.choice([10, 60, 200]))], "uint64"))
            for _ in range(20)]
    sets = []
    for b in base:
        for _ in range(8):
            keep = J.np.array([rnd.random() < rnd.choice([0.95, 0.87, 0.8]) for _ in b])
            sets.append(b[keep])
    sets = [s for s in sets if len(s)]
    points, sizes = J.np.stack([J.count_vector(s) for s in sets]), J.np.array([len(s) for s in sets])
    back, fine = J.unpack_points([J.pack_point(*J.set_points(s)) for s in sets])
    assert (back == points).all()
    assert J.unpack_points([J.pack_point(points[0] + 300)])[0].min() > 10**6
    tree = J.CountTree(points, sizes, fine=fine)
    for i, s in enumerate(sets):
        near = set(tree.near(i).tolist())
        assert {j for j, o in enumerate(sets) if J.linked(s, o)} <= near


def test_forest_connects_what_brute_force_links():
    rnd = random.Random(9)
    for _ in range(30):
        base = [rnd.getrandbits(64) for _ in range(120)]
        sets = [J.np.unique(J.np.array([x for x in base if rnd.random() < 0.93] + [rnd.getrandbits(64) for _ in range(8)],
                                       "uint64")) for _ in range(rnd.choice([2, 9, 70]))]
        root = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if J.linked(sets[i], sets[j]):
                    root = [root[j] if r == root[i] else r for r in root]
        got = list(range(len(sets)))
        for i, j in J.link_forest(sets):
            assert J.linked(sets[i], sets[j])
            got = [got[j] if r == got[i] else r for r in got]
        assert [[a == b for b in root] for a in root] == [[a == b for b in got] for a in got]


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (7, 7), (60, 30)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and {got[100], got[101], got[102]} == {100}


def test_the_nodes_of_a_common_shingle_do_not_meet_in_one_task(spark, monkeypatch, tmp_path):
    """Documents of one template, too different to link by the bound, stay nodes of their own under its shingles."""
    rnd = random.Random(12)
    template = " ".join(f"t{i}" for i in range(164))
    own = lambda k: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(k))
    rows = [(i, template + " " + own(40)) for i in range(400)]
    rows += [(1000 + i, t + f" z{i}") for i, (_, t) in enumerate(rows[::20])]  # and near copies of some
    whole = J._node_edges

    def spy(batches):
        import os
        import uuid
        from collections import Counter

        seen = Counter()

        def counted():
            for b in batches:
                seen.update(zip(*(b.column(n).to_pylist() for n in b.schema.names if n in ("token", "lo", "hi"))))
                yield b

        yield from whole(counted())
        with open(os.path.join(str(tmp_path), uuid.uuid4().hex), "w") as f:
            f.write(str(max(seen.values(), default=0)))

    monkeypatch.setattr(J, "_node_edges", spy)
    monkeypatch.setattr(J, "NODE_BLOCK", 40, raising=False)
    monkeypatch.setattr(J, "TREE_SETS", 1, raising=False)
    assert run(spark, rows) == brute(rows)
    most = max(int(p.read_text()) for p in tmp_path.iterdir())
    assert 0 < most < 4 * 40


def test_a_partner_is_kept_wherever_two_sets_can_link():
    rnd = J.np.random.default_rng(4)
    for _ in range(300):
        run = J.np.sort(rnd.integers(0, 12, 30))
        n = rnd.integers(1, rnd.choice([9, 60, 400]), 30)
        far = J.farthest(n, J.np.array([rnd.integers(0, J.prefix_size(int(k))) for k in n]))
        got, size = J.with_partner(run, n, far), J.np.bincount(run, minlength=12)
        for i in range(30):
            want = any(run[i] == run[j] and n[j] <= far[i] and n[i] <= far[j] for j in range(30) if i != j)
            assert got[i] >= want and (got[i] == want or size[run[i]] > 2)


def test_places_rule_out_buckets_but_no_link():
    """Under the first shingle that two sets share, all others they share come later: nothing else is left out."""
    rnd = random.Random(6)
    for _ in range(400):
        n = rnd.choice([3, 8, 40, 200])
        a = {rnd.getrandbits(40) for _ in range(n)}
        b = {x for x in a if rnd.random() < 0.93} | {rnd.getrandbits(40) for _ in range(rnd.randrange(n // 6 + 1))}
        a, b = (J.np.array(sorted(x), "uint64") for x in (a, b))
        if len(b) and J.linked(a, b):
            one = min(set(a.tolist()) & set(b.tolist()))
            x, y = (J.np.searchsorted(s, J.np.uint64(one)) for s in (a, b))
            assert x < J.prefix_size(len(a)) and y < J.prefix_size(len(b))
            assert len(b) <= J.farthest(J.np.int64(len(a)), x) and len(a) <= J.farthest(J.np.int64(len(b)), y)


def test_sets_that_share_a_late_shingle_alone_meet_in_no_bucket():
    """Two sets of 100 under their 20th shingle can overlap in 81 at most; of the third run one has its partner's size."""
    import pyarrow as pa

    rows = [(1, -1, 10, 100, 19), (1, -1, 11, 100, 19), (2, -1, 10, 100, 3), (2, -1, 12, 70, 0), (3, -1, 10, 100, 3), (3, -1, 13, 99, 5),
            (4, 0, 10, 100, 24)]
    cols = [pa.array([(r[3] << 32) + r[4] if i == 3 else r[i] for r in rows], pa.int64()) for i in range(4)]
    out = pa.Table.from_batches(J._shared(iter([pa.RecordBatch.from_arrays(cols, names=["token", "salt", "set_id", "place"])])))
    assert out.column("set_id").to_pylist() == [10, 13, 10] and out.column("salt").to_pylist() == [-1, -1, 0]


def test_only_texts_of_clusters_travel(spark):
    """Marks keep every wanted row, null ids included, and leave out nearly all others."""
    from genolake.llm.common import may_match

    rows = spark.createDataFrame([(i, f"t {i}") for i in range(2000)] + [(None, "n"), (7, None), (7, "t 7")], "doc_id long, text string")
    wanted = rows.where("doc_id % 100 = 7 or doc_id is null or text is null").select("text", "doc_id")
    got = [tuple(r) for r in may_match(rows, wanted, ["doc_id", "text"]).collect()]
    need = [tuple(r) for r in rows.join(wanted.distinct(), rows["doc_id"].eqNullSafe(wanted["doc_id"])
                                        & rows["text"].eqNullSafe(wanted["text"]), "left_semi").collect()]
    assert len(need) == 23 and not set(need) - set(got) and got.count((7, "t 7")) == 2 and len(got) < 40
    assert may_match(rows, wanted.limit(0), ["doc_id", "text"]).count() == 0
