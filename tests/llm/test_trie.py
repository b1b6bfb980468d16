import collections
import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from visitflow.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns (role, text) by conv_id in their defined order."""
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, digest), role, text))
    return {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs):
    """The rows of the trie, every conversation walked turn by turn."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(path))))
        rows.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in below) for p in below), saved,
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def random_rows(seed, convs=60, longest=40):
    """Conversations that copy the beginning of others, with blocks shared, cut and left."""
    r = random.Random(seed)
    kept, rows = [[]], []
    for c in range(convs):
        start = r.choice(kept)
        turns = start[: r.choice([0, 1, 7, 8, 9, 16, len(start)])]
        turns = turns + [(r.choice(["user", "assistant"]), " ".join(r.choice("ab") for _ in range(r.randrange(4))))
                         for _ in range(r.randrange(longest - len(turns)) if len(turns) < longest and r.random() < 0.7 else 0)]
        kept.append(turns)
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    return rows


def test_trie_like_brute_force(spark):
    for seed in range(3):
        rows = random_rows(seed)
        turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert got(trie.prefix_trie(turns)) == brute(ordered(rows))


def test_query_like_brute_force(spark, tmp_path):
    rows = random_rows(9, convs=90, longest=12)
    rows = [r for r in rows if r[0] != 40]                                    # a model that is absent: 41..59 lose their start
    rows += [(60, 90, None, None), (61, None, None, "null turn first"), (61, None, "user", None), (None, 1, "user", "no conversation")]
    rows += [(62, 3, "user", "twice"), (62, 3, "user", "twice"), (62, 3, "user", "tie"), (5, 200, "user", "long text " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(-1)).withColumn("words", F.lit("clash")).withColumn("n", F.lit(0))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute(rebuilt(ordered(rows)))
    assert got(queries.op11_prefix_trie(spark, str(tmp_path))) == want
    assert any(len(t) == 0 for t in rebuilt(ordered(rows)).values())


def test_one_conversation_over_many_partitions_and_segments(spark, monkeypatch):
    monkeypatch.setattr(trie, "SEGMENT", 2)
    rows = [(7, k, "user", f"turn {k % 5}") for k in range(400)] + [(8, k, "user", f"turn {k % 5}") for k in range(333)] + [(9, 0, "user", "x")] * 50
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert got(trie.prefix_trie(turns)) == brute(ordered(rows))


def test_ids_of_a_node_go_through_the_hash_in_ranges(spark):
    n = 70_000  # more than one range of ids
    df = spark.range(n).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("same").alias("text"))
    rows = got(trie.prefix_trie(trie.ordered_turns(df)))
    ids = hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert rows == sorted([(0, 0, None, n, 1, 1, n - 1, hashlib.sha256(b"").hexdigest()), (0, 1, 0, n, 0, 1, n - 1, ids)], key=repr)


def test_empty_table_has_no_root(spark):
    assert got(trie.prefix_trie(trie.ordered_turns(spark.createDataFrame([], SCHEMA)))) == []


def test_siblings_share_a_block_once(spark):
    """Many copies of two conversations that part inside one block: its turns are grouped for two blocks, not for all copies."""
    rows = [(c, k, "user", f"t{k}" if k < 11 or c % 2 else f"s{k}") for c in range(200) for k in range(20)]
    turns = trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    paths = trie._paths(turns).select("*", F.lit(0).alias("shared"), F.lit(0).alias("leaf"))
    assert paths.groupBy("up", "end").count().count() == 5
    assert got(trie.prefix_trie(turns)) == brute(ordered(rows))
