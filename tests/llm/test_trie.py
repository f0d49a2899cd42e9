import hashlib
import random
import zlib

from pyspark.sql import functions as F

from loadledger.llm import QUERIES
from loadledger.llm.trie import ends_digests, node_turns, numbered_turns, prefix_trie, spliced

TURNS = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    """The spliced conversations as lists of (role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [row[3:] for row in sorted(said)] for c, said in own.items()}
    made = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        made[c] = own.get(base, [])[:h] + said[h:]
    return made


def brute(rows):
    made = rebuilt(rows)
    nodes = {}
    for c, said in made.items():
        for d in range(len(said) + 1):
            nodes.setdefault(tuple(said[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(key))))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                    sum(len(k) == len(key) + 1 for k in below),
                    sum(not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in below) for k in below),
                    sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(r[name] for name in NAMES) for r in frame.collect()), key=repr)


def hard():
    random.seed(8)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(250, 260), 300, -7, -103, -100]:
        for t in range(random.randrange(0, 9)):
            rows.append((c, t if random.random() < 0.9 else None, random.choice(["user", "assistant", None, ""]),
                         random.choice(["hi", "yes é", None, "", "日本"])))
    rows += [(5, 3, "user", "same"), (5, 3, "user", "same"), (5, 3, "ann", "same"), (None, 1, "user", "nobody's"),
             (None, None, None, None), (300, 1, "user", "x" * 100_000)]
    return rows


def test_hard_rows_agree_with_brute_force_and_sql(spark, tables, agrees):
    rows = hard()
    folder = tables(conversations=(rows, TURNS))
    assert got(QUERIES["op13_conversation_trie"](spark, folder)) == brute(rows)
    agrees("op13_conversation_trie", QUERIES["op13_conversation_trie"](spark, folder), folder)


def test_agrees_with_sql_on_given_tables(spark, sf_dir, agrees):
    agrees("op13_conversation_trie", QUERIES["op13_conversation_trie"](spark, sf_dir), sf_dir)


def test_a_hot_conversation_and_many_copies(spark, tables, agrees):
    rows = [(3, i, f"r{i % 2}", f"m{i % 7}") for i in range(3000)] + [(3, None, "a", "b")] * 5
    rows += [(1000 + i, t, "user", f"t{t}") for i in range(700) for t in range(8)]
    folder = tables(conversations=(rows, TURNS))
    agrees("op13_conversation_trie", QUERIES["op13_conversation_trie"](spark, folder), folder)


def test_lists_of_ends_in_many_pieces(spark):
    members = spark.range(1000).select(
        F.when(F.col("id") < 900, F.lit(b"hot")).otherwise(F.col("id").cast("string").cast("binary")).alias("key"),
        (F.col("id") * 7919 % 1009).alias("conv_id"))
    want = {}
    for r in members.collect():
        want.setdefault(bytes(r.key), []).append(r.conv_id)
    want = {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
    assert {bytes(r.key): r.ends_sha256 for r in ends_digests(members, piece=7).collect()} == want


def test_nodes_carry_their_last_turn(spark):
    rows = hard()
    conversations = spark.createDataFrame(rows, TURNS)
    made = rebuilt(rows)
    nodes = prefix_trie(*spliced(numbered_turns(conversations)))
    told = node_turns(nodes, conversations).collect()
    assert len(told) == len(brute(rows))
    for r in told:
        assert (r.role, r.text) == (made[r.conv_id][r.depth - 1] if r.depth else (None, None))


def test_empty_table_and_clashing_columns(spark):
    shape = TURNS + ", place int, key string, digest string, first int, weight int"
    assert got(prefix_trie(*spliced(numbered_turns(spark.createDataFrame([], shape))))) == []
    one = spark.createDataFrame([(9, 1, "a", "b", 3, "c", "d", 4, 5)], shape)
    assert got(prefix_trie(*spliced(numbered_turns(one)))) == brute([(9, 1, "a", "b")])
