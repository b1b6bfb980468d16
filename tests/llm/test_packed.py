import random
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import roots

from visitflow.llm import packed

KIND = np.dtype([("key", "<i8"), ("node", "<i8"), ("n", "<u4"), ("simhash", "<u8")])


def rows_of(seed, keys=40, rows=600):
    r = random.Random(seed)
    return [(r.randrange(-keys, keys) * 2**40 + 7, node, node % 50) for node in (r.randrange(300) for _ in range(rows))]


def functions():
    """posts and near, made here so that they travel to the tasks by value."""
    kind = KIND

    def posts(batches):
        for batch in batches:
            out = np.empty(batch.num_rows, kind)
            for k, name in enumerate(kind.names[:3]):
                out[name] = batch.column(k).to_numpy()
            out["simhash"] = out["node"]
            yield out

    return posts, lambda own, a, b: own["n"][b] - own["n"][a] <= 3


def test_sets_are_what_near_connects(spark, monkeypatch):
    posts, near = functions()
    for most in (2048, 5):
        monkeypatch.setattr(packed, "MOST_COMPARED", most)
        rows = rows_of(1)
        source = spark.createDataFrame(rows, "key long, node long, n long").repartition(4)
        got = {}
        for r in packed.met_sets(source, posts, KIND, "n", near, 16).collect():
            got.setdefault(r.key, set()).add(r.node)
        want = set()
        for key in {k for k, _, _ in rows}:
            own = sorted({(n, node) for k, node, n in rows if k == key})
            if len(own) > most:
                want.add(frozenset(node for _, node in own))
                continue
            root = roots(len(own), [(i, j) for i in range(len(own)) for j in range(i) if abs(own[i][0] - own[j][0]) <= 3])
            for top in set(root):
                nodes = frozenset(own[k][1] for k in range(len(own)) if root[k] == top)
                if len(nodes) > 1:
                    want.add(nodes)
        sets = {frozenset(s) for s in got.values()}
        # tasks have their own constants: below them they compare long lists as well
        assert want <= sets and (most == 5 or (sets == want and len(got) == len(want)))


def test_the_row_most_others_are_like_comes_first():
    hashes = np.array([0b111, 0b1111, 0b1011, 0b1111, 0, 0, 0b1], np.uint64)
    assert packed._from_majority(hashes, np.array([0, 4])).tolist() == [1, 0, 1, 0, 0, 0, 1]


def test_met_posts_have_a_partner(spark):
    posts, near = functions()
    rows = rows_of(2)
    source = spark.createDataFrame(rows, "key long, node long, n long").repartition(3)
    got = {(r.key, r.node) for r in packed.met_posts(source, posts, KIND, "n", near, 16).collect()}
    assert got == {(k, a) for k, a, n in rows if any(k == j and a != b and abs(n - m) <= 3 for j, b, m in rows)}


def test_repeated_keys_hold_every_key_of_two_rows(spark):
    rows = [(random.Random(k).randrange(400) * 2**33 + k % 3,) for k in range(900)]
    keys = lambda batches: (b.column(0).to_numpy() for b in batches)
    found = {r.key for r in packed.repeated_keys(spark.createDataFrame(rows, "key long").repartition(5), keys, 8).collect()}
    times = Counter(k for k, in rows)
    want = {int(packed.brief(np.array([k]), 8)[0]) for k, n in times.items() if n > 1}
    assert want <= found and len(found) <= len(want) + 3


def test_nothing_gives_nothing(spark):
    posts, near = functions()
    empty = spark.createDataFrame([], "key long, node long, n long")
    assert packed.met_sets(empty, posts, KIND, "n", near, 4).count() == 0 == packed.met_posts(empty, posts, KIND, "n", near, 4).count()
    assert list(packed.gathered([])) == [] and packed.dealt(np.zeros(0, KIND), np.zeros(0, np.int64)).num_rows == 0
    assert isinstance(packed._column(np.zeros((2, 2), np.uint64)), pa.Array)


def test_labels_stay_right_when_pairs_come_in_parts():
    r = np.random.default_rng(5)
    label, parent = np.arange(300), {}

    def root(n):
        while parent.get(n, n) != n:
            n = parent[n]
        return n

    for _ in range(6):
        x, y = r.integers(0, 300, (2, 40))
        label = packed._settled(label, [(x[:7], y[:7]), (x[7:], y[7:])])
        for a, b in zip(x.tolist(), y.tolist()):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        assert label.tolist() == [root(n) for n in range(300)]


def test_a_bucket_is_unpacked_on_its_own():
    keys = np.array([3, 3, 9, 9, 12, 40], np.int64)
    rows = np.zeros(6, KIND)
    rows["key"], rows["node"] = keys, np.arange(6)
    batches = [packed.dealt(rows[part], packed.bucket_of(keys[part], 4)) for part in (slice(0, 6, 2), slice(1, 6, 2))]
    lists = [packed._lists(parts, KIND, "n")[0] for parts in packed._buckets(batches)]
    assert sorted(n for rows in lists for n in rows["node"].tolist()) == list(range(6))
    assert [len(set(packed.bucket_of(rows["key"].copy(), 4).tolist())) for rows in lists] == [1] * len(set(packed.bucket_of(keys, 4).tolist()))


def test_parts_are_the_whole(monkeypatch):
    monkeypatch.setattr(packed, "PACKED", 3)
    rows = np.zeros(500, KIND)
    rows["key"] = np.arange(500) % 70
    bucket = packed.bucket_of(rows["key"].copy(), 16)
    order = np.argsort(bucket, kind="stable")
    whole, parts = packed.dealt(rows, bucket), list(packed.dealt_parts(rows[order], bucket[order]))
    assert len(parts) == -(-whole.num_rows // 3) and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()
    assert list(packed.dealt_parts(rows[:0], bucket[:0])) == []
