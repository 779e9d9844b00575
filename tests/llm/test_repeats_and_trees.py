"""Manifest, hard negatives, induced sorting and suffix-array dedup against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import manifest, negatives, suffix_dedup
from cardlens.llm.induced import Scratch, sorted_suffixes
from cardlens.llm.queries import ORACLES, QUERIES
from cardlens.operators import lookup_join
from odd import docs_of, odd_rows  # noqa: F401 (fixtures)

SF_DIR = "/root/testdata/sf0.001"


def same_as_sql(spark, name, table, sf_dir=SF_DIR):
    got = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected) and expected


# --- Manifest ---


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(hashes, fan):
    """Root, and for each place its runs."""
    paths, nodes, owners = [[] for _ in hashes], list(hashes), [[i] for i in range(len(hashes))]
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for at, own in enumerate(owners):
            for i in own:
                paths[i].append((at % fan, runs[at // fan]))
        owners = [sum(owners[i:i + fan], []) for i in range(0, len(owners), fan)]
        nodes = [sha(*run) for run in runs]
    return nodes[0], paths


def slow_manifest(rows, fan):
    groups = defaultdict(list)
    for doc, lang, leaf in rows:
        groups[lang].append((doc is not None, doc or 0, leaf, doc))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: slow_tree([x[2] for x in sorted(groups[g])], fan) for g in order}
    root, tops = slow_tree([trees[g][0] for g in order], fan)
    return sorted(
        (repr((doc, g, leaf)), trees[g][0], root, trees[g][1][i] + tops[k])
        for k, g in enumerate(order) for i, (_, _, leaf, doc) in enumerate(sorted(groups[g]))
    )


@pytest.mark.parametrize("fan, levels", [(8, 3), (2, 2), (3, 1)])
def test_paths_equal_brute_force(spark, fan, levels):
    rng = random.Random(fan)
    rows = [(i, rng.choice(["en", "de", None, "", "é", "z"]), sha(str(i))) for i in rng.sample(range(3000), 150)]
    rows += [(7000, "alone", sha("alone")), (None, "en", sha("no id")), (None, None, sha("nothing"))] + rows[:1] * 20
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, lang string, leaf string, row int")
    got = manifest.prove(df, fan=fan, levels=levels).withColumn("folded", manifest.folded(F.col("row.leaf"), F.col("path"))).collect()
    assert all(r["folded"] == r["root"] for r in got)
    assert sorted((repr(tuple(r["row"][:3])), r["subroot"], r["root"], [(s["at"], s["run"]) for s in r["path"]]) for r in got) == slow_manifest(rows, fan)


def test_a_proof_fails_for_another_leaf(spark):
    df = spark.createDataFrame([(i, "en", sha(str(i))) for i in range(70)], "doc_id long, lang string, leaf string")
    proven = manifest.prove(df)
    assert proven.where(manifest.folded(F.lit(sha("other")), F.col("path")) == F.col("root")).isEmpty()
    others = proven.select("row.doc_id", manifest.siblings(F.col("path")).alias("s")).orderBy("doc_id").first()["s"]
    assert others.startswith("".join(sha(str(i)) for i in range(1, 8)))
    empty = manifest.prove(df.limit(0))
    assert empty.columns == ["row", "subroot", "root", "path"] and empty.count() == 0


def test_row_hash(spark):
    row = spark.range(1).select(manifest.row_hash([F.lit(12), F.lit(None).cast("string"), F.lit(""), F.lit("é")]).alias("h")).first()
    assert row["h"] == sha("2:12", "-", "0:", "2:é")


def test_manifest_equals_sql_and_marks_changed_texts(spark):
    same_as_sql(spark, "op11_manifest", "documents")
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    changed = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in r["text"] or "")}
    got = {r["doc_id"]: r["verified"] for r in QUERIES["op11_manifest"](spark, SF_DIR).collect()}
    assert changed and {d for d, ok in got.items() if not ok} == changed


def test_conversations_equal_sql(spark):
    same_as_sql(spark, "op7_chat", "conversations")


# --- Hard negatives ---


def test_looked_up_scores_are_inner_products():
    rng = np.random.default_rng(2)
    for dims in (1, 7, 8, 9, 64):
        a, c = rng.integers(-300, 300, (5, dims)), rng.integers(-(2**rng.integers(1, 20)), 2**12, (40, dims))
        bits = int(np.abs(c).max()).bit_length() + 1
        assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c, bits)) == c @ a.T).all()


def slow_negatives(rows, every, positives, negatives_, least=50, most=95):
    sound = [
        (row, i, label, [int(np.floor(256 * x)) for x in v]) for row, (i, v, label) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for row, i, label, v in sound:
        if i % every:
            continue
        ranked = sorted((-sum(map(int.__mul__, v, w)), j, other, l) for other, j, l, w in sound if other != row and len(w) == len(v))
        for score, j, _, _ in [x for x in ranked if x[3] == label][:positives]:
            fits = [x for x in ranked if x[3] != label and least * -score <= 100 * -x[0] <= most * -score][:negatives_]
            out += [(i, j, n + 1, x[1], -score, -x[0]) for n, x in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("settings", [negatives.Settings(), negatives.Settings(anchors=2, candidates=7)])
def test_negatives_equal_brute_force(spark, settings):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) + 0.5).tolist(), int(rng.integers(0, 3))) for i in range(80)]
    rows += [(i, [1.0, 0.5, 1.0, 0.25, 1.0, 0.5], i % 2) for i in range(100, 130)]  # ties go to the smaller id
    rows += [(200, None, 1), (205, [1.0] * 6, None), (210, [1.0, None] * 3, 1), (215, [float("nan")] * 6, 1), (220, [float("inf")] * 6, 1),
             (None, [1.0] * 6, 1), (225, [1.0, 2.0], 1), (230, [2.0, 1.0], 1), (231, [0.5, 1.0], 0), (235, [], 1), (236, [], 1), (240, [0.0] * 6, 2),
             (245, [-1.0] * 6, 1)] + rows[10:11] * 3
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id long, embedding array<float>, label int, score double, row int")
    given = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = negatives.hard_negatives(df, every=5, positives=4, negatives=2, settings=settings)
    expected = slow_negatives(given, 5, 4, 2)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 50
    assert negatives.hard_negatives(df.limit(0)).count() == 0


def test_negatives_equal_sql(spark):
    same_as_sql(spark, "op12_negatives", "embeddings")


# --- Induced sorting ---


def slow_suffixes(s, most):
    order = sorted(range(len(s)), key=lambda i: s[i:], reverse=True)
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < most and max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        common.append(n)
    return order, common


def suffixes(s, most, kind="u1", **settings):
    scratch = Scratch(**settings)
    parts = list(sorted_suffixes(np.array(list(s), kind), scratch, most))
    return np.concatenate([p[0] for p in parts]).tolist(), np.concatenate([p[1] for p in parts]).tolist(), scratch


@pytest.mark.parametrize("seed", range(12))
def test_suffixes_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(6):
        n, k = rng.choice([0, 1, 2, 7, 60, 500]), rng.choice([1, 2, 3, 9, 250])
        words = [bytes(rng.randint(1, k) for _ in range(rng.randint(1, 30))) for _ in range(rng.choice([1, 2, 5, 200]))]
        s = b"".join(rng.choice(words) for _ in range(n))[:n] + b"\0"
        most = rng.choice([1, 4, 400])
        memory, block = rng.choice([64, 2000, 1 << 26]), rng.choice([3, 64, 1 << 16])
        assert suffixes(s, most, memory=memory, block=block)[:2] == slow_suffixes(s, most)


def test_long_runs_periods_and_wide_symbols():
    for s in (b"a" * 3000 + b"\0", b"ab" * 1500 + b"\0", b"abcabd" * 300 + b"c" * 200 + b"\0", b"ba" * 400 + b"ab" * 400 + b"\0"):
        assert suffixes(s, 400, memory=4000, block=50)[:2] == slow_suffixes(s, 400)
    rng = random.Random(1)
    wide = [rng.choice([1, 300, 65000]) for _ in range(600)] + [0]
    assert suffixes(wide, 50, kind="u2", block=30)[:2] == slow_suffixes(wide, 50)


def test_a_text_far_larger_than_memory_goes_to_files(tmp_path):
    rng = random.Random(5)
    words = [bytes(rng.randint(1, 60) for _ in range(rng.randint(2, 9))) for _ in range(300)]
    s = b"".join(rng.choice(words) for _ in range(40_000)) + b"\0"
    order, common, scratch = suffixes(s, 100, memory=50_000, block=1000, folder=str(tmp_path))
    assert scratch.spilled > 10 * 50_000 and not list(tmp_path.iterdir())
    assert (order, common) == suffixes(s, 100)[:2]
    assert sorted(order) == list(range(len(s)))
    for a, b, n in list(zip(order, order[1:], common[1:]))[::500]:
        assert s[a:] > s[b:] and s[a:a + n] == s[b:b + n] and (n == 100 or s[a + n] != s[b + n])


# --- Dedup ---


def slow_dedup(rows, least):
    seen = Counter(b[i:i + least] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - least + 1))
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if seen[b[i:i + least]] > 1:
                gone[i:i + least] = b"\1" * least
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def digests(found):
    return sorted(
        ((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
         for r in found.collect()), key=repr,
    )


@pytest.mark.parametrize("least, settings", [
    (12, suffix_dedup.Settings()), (12, suffix_dedup.Settings(shard=300, memory=500, block=16)),
    (5, suffix_dedup.Settings(hot=40)), (30, suffix_dedup.Settings(shard=50, hot=100)), (1, suffix_dedup.Settings()),
])
def test_dedup_equals_brute_force(spark, docs_of, odd_rows, least, settings):
    rng = random.Random(least)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randint(3, 80))) for _ in range(6)]
    rows = odd_rows + [(8, "ab" * 300)]
    for i in range(60):
        parts = (rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choice("abcdefghé ") for _ in range(rng.randint(1, 40))) for _ in range(5))
        rows.append((i, "".join(parts)))
    # A passage that many hold, each among other words: the different pieces of its markers are many.
    rows += [(i, f"{i * 7919}" + passages[0] * 3 + f"{i * 104729}") for i in range(100, 160)]
    assert digests(suffix_dedup.remove_repeats(docs_of(rows), least, settings=settings)) == slow_dedup(rows, least)


@pytest.mark.parametrize("settings", [suffix_dedup.Settings(), suffix_dedup.Settings(hot=100)])
def test_dedup_without_broadcasts_equals_brute_force(spark, docs_of, odd_rows, conf, monkeypatch, settings):
    """As over tables whose lookups, by digests and markers, are all too large to be broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(
        suffix_dedup, "lookup_join", lambda facts, lookup, key, by, how="inner", most=0: lookup_join(facts, lookup, key, by, how, -1)
    )
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = odd_rows + [(i, rng.choice(texts[:4]) + rng.choice(texts) + texts[0]) for i in range(100, 200)] + [(7, texts[1] * 2)] * 60
    assert digests(suffix_dedup.remove_repeats(docs_of(rows), 12, settings=settings)) == slow_dedup(rows, 12)


def test_dedup_of_nothing(spark, docs_of):
    empty = suffix_dedup.remove_repeats(docs_of([(1, "a")]).limit(0))
    assert empty.columns == ["doc_id", "n_bytes", "spans", "kept"] and empty.count() == 0


def test_any_bytes_and_texts_longer_than_a_block(spark):
    rng = random.Random(9)
    long = bytes(rng.randrange(256) for _ in range(300_000))
    rows = [(1, long), (2, long[130_900:131_500]), (3, b"\xff\xfe\0" * 200)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text binary"), 400)
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["spans"]] for r in found.collect()}
    assert got == {1: [(130_900, 131_500)], 2: [(0, 600)], 3: [(0, 600)]}


def test_dedup_of_the_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_suffix_dedup"](spark, SF_DIR).collect()), key=repr)
    assert got == slow_dedup(rows, 400) and sum(r[2] for r in got) > 0
