"""Shards, SimHash, decontamination, quality, licences and the pipeline against brute force on small tables."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardlens.llm import components, decontaminate, licences, quality, sharding, simhash
from conftest import plan
from odd import docs_of, odd_rows  # noqa: F401 (fixtures)

SF_DIR = "/root/testdata/sf0.001"


# --- Shards ---


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards_hold_every_row_once(spark, docs_of, odd_rows, tmp_path, shards):
    df = docs_of(odd_rows).withColumn("bytes", F.octet_length("text").cast("long"))
    n = sharding.shuffle_to(df, str(tmp_path / "s"), "bytes", seed=1, bucket_bytes=20_000)
    rows = sharding.read_shards(spark, str(tmp_path / "s"), shards).collect()
    assert n == len(rows) == len(odd_rows)
    assert Counter((r["row"]["doc_id"], r["row"]["text"]) for r in rows) == Counter(odd_rows)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    assert rows[0]["row"].asDict().keys() == set(df.columns)


def test_shards_of_an_empty_table(spark, docs_of, tmp_path):
    sharding.shuffle_to(docs_of([]).withColumn("bytes", F.lit(1).cast("long")), str(tmp_path / "e"), "bytes")
    assert sharding.read_shards(spark, str(tmp_path / "e"), 4).count() == 0


def test_shuffle_follows_its_seed_and_mixes(spark, tmp_path):
    spark.range(4000).withColumn("bytes", F.lit(100).cast("long")).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    order = []
    for i, seed in enumerate((1, 1, 2)):
        sharding.shuffle_to(df, str(tmp_path / f"o{i}"), "bytes", seed, bucket_bytes=50_000)
        rows = sharding.read_shards(spark, str(tmp_path / f"o{i}"), 4).collect()
        order.append([r["row"]["id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))])
    assert order[0] == order[1] != order[2]
    assert sorted(order[0]) == list(range(4000))
    assert abs(np.corrcoef(order[0], range(4000))[0, 1]) < 0.1
    assert "Python" not in plan(sharding.read_shards(spark, str(tmp_path / "o0"), 4))


# --- SimHash ---


def slow_fingerprint(text: str) -> int:
    words = [w for w in text.encode().translate(simhash._LOWER).split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(points, near):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in points:
        for b in points:
            if a < b and near(a, b):
                parent[find(a)] = find(b)
    return {p: find(p) for p in points}


def test_fingerprints_equal_the_definition(odd_rows):
    rng = random.Random(3)
    texts = [t or "" for _, t in odd_rows] + [" ".join(rng.choices(["a", "B", "\x0bc", "é d", "\n"], k=n)) for n in range(0, 700, 37)]
    assert simhash.fingerprints(texts).tolist() == [slow_fingerprint(t) for t in texts]


def test_near_duplicates_equal_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(1)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(rng.randrange(50)) for _ in range(300)] for _ in range(12)]
    rows = list(odd_rows)
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(300)] = "changed"
        rows.append((1000 - i, " ".join(words)))
    found = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(found) == len(rows)
    prints = {t: slow_fingerprint(t or "") for _, t in rows}
    root = groups_of(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, t in rows:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], 1 << 62))
    expected = Counter((i, prints[t], least.get(root[prints[t]])) for i, t in rows)
    assert Counter((r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in found) == expected
    kept = simhash.drop_near_duplicates(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    assert len(kept.collect()) == len(set(root.values()))
    assert {r["doc_id"] for r in kept.collect()} == {least.get(r) for r in set(root.values())}
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0


@pytest.mark.parametrize("most", [100_000, 60, 3])
def test_hot_signatures_are_split_without_losing_a_component(spark, most):
    rng = random.Random(2)
    points = {rng.getrandbits(64) for _ in range(40)}
    for p in list(points):
        points |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(8)}
    centre = rng.getrandbits(64)
    points |= {centre ^ 1 << i ^ 1 << j for i in range(30) for j in range(i)}
    signed = {p: p - 2**64 if p >> 63 else p for p in points}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    links = {(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(df, 4, most).collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    wanted = groups_of(points, lambda a, b: (a ^ b).bit_count() <= 4)
    got = groups_of(points, lambda a, b: (a, b) in links or (b, a) in links)
    same = lambda g: {frozenset(p for p in points if g[p] == r) for r in set(g.values())}
    assert same(got) == same(wanted)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (10, 9), (9, 8), (8, 7), (7, 6), (6, 10), (20, 21), (20, 21), *((100, n) for n in range(101, 160))]
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6, 20: 20, 21: 20, **{n: 100 for n in range(100, 160)}}
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    assert {r["component"] for r in components.connected_components(chain).collect()} == {0}
    assert components.connected_components(chain.limit(0)).count() == 0


# --- Decontamination ---


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_equals_the_table():
    rng = random.Random(4)
    for _ in range(200):
        a, b = (rng.choices(range(6), k=rng.randrange(40)) for _ in "ab")
        assert decontaminate.lcs(a, b) == slow_lcs(a, b)


def test_svd_spans_what_numpy_spans(spark):
    rng = np.random.default_rng(1)
    dense = rng.random((30, 50)) * (rng.random((30, 50)) < 0.2)
    rows = [(np.flatnonzero(r).tolist(), r[r > 0].tolist()) for r in dense]
    v = decontaminate.randomised_svd(spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(3), 50, 64, 8, 1)
    assert v.shape[1] == np.linalg.matrix_rank(dense)
    assert np.allclose(dense @ v @ v.T, dense, atol=1e-3)


@pytest.fixture(scope="module")
def leaks(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices(["ba", "ne", "ri", "to", "su", "mo", "li"], k=rng.randrange(2, 5)))
    sentence = lambda n: " ".join([*(word() for _ in range(n)), "the", "of"]).capitalize() + "."
    items = [(i, f"{sentence(14)} {sentence(9)}") for i in range(25)] + [(98, None), (99, " .. ")]
    texts = {n: " ".join(sentence(12) for _ in range(rng.randrange(1, 40))) for n in range(120)}
    planted = set()
    for n in range(0, 120, 6):
        i = n % 25
        words = items[i][1].split()
        if n % 12:  # a paraphrase: a few words differ or are left out
            words = ["otherwise" if k in (3, 8) else w for k, w in enumerate(words) if k != 5]
        texts[n] += "\n" + " ".join(words).upper() + "\n" + sentence(20)
        planted.add((n, i))
    half = items[1][1].split(". ")[0] + "."
    texts[121] = sentence(30) + " " + half + " " + sentence(30)  # the question without its answer
    return items, texts, planted


def test_planted_items_are_found_and_others_left_alone(spark, docs_of, odd_rows, leaks):
    items, texts, planted = leaks
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [*texts.items(), *((None if i is None else i + 1000, t) for i, t in odd_rows)]
    docs = docs_of(rows)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert found == planted
    small = decontaminate.Settings(block_bytes=1000)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark, settings=small).collect()} == planted
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(r for r in rows if r[0] not in {d for d, _ in planted})
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, benchmark.limit(0)).count() == len(rows)


@pytest.fixture(scope="module")
def many_leaks():
    """Items of 5 to 60 words, and documents of the same words with items in them, every other one paraphrased."""
    rng = random.Random(5)
    words = ["".join(rng.choices(["ba", "ne", "ri", "to", "su", "mo", "li", "ka"], k=rng.randrange(2, 5))) for _ in range(3000)]
    weights = [1 / (i + 1) ** 0.8 for i in range(3000)]
    draw = lambda n: rng.choices(words, weights, k=n)
    items = [(i, " ".join(draw(5 + i % 56))) for i in range(1200)]
    docs, planted = [], []
    for i, text in items:
        kept = text.split()
        if i % 2:  # a quarter of the words differ, all of them before the answer
            for k in rng.sample(range(len(kept) - max(3, len(kept) // 4)), len(kept) // 4):
                kept[k] = "otherwise"
        docs.append((i, " ".join([*draw(rng.randrange(10, 60)), *kept, *draw(rng.randrange(10, 60))])))
        planted.append((i, i))
    return items, docs, planted


def slow_leaks(items, docs):
    """Every document against every item, a stretch from every term on; no space, no windows."""
    out = set()
    for d, text in docs:
        words = text.split()
        have = set(words)
        for i, item in items:
            wanted, answer = item.split(), decontaminate.answer_of(item)
            n = len(wanted)
            if sum(w in have for w in wanted) < 0.7 * n:
                continue
            step = max(1, n // 8)
            for a in range(0, len(words), step):
                stretch = words[a:a + n + max(4, n // 2) + step - 1]
                if sum(map(set(stretch).__contains__, wanted)) >= 0.7 * n and decontaminate.lcs(wanted, stretch) / n >= 0.7 and decontaminate.lcs(answer, stretch) >= 0.7 * len(answer):
                    out.add((d, i))
                    break
    return out


def test_no_leak_is_lost_among_many_items_long_or_short(spark, docs_of, many_leaks):
    items, docs, planted = many_leaks
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs_of(docs), benchmark).collect()}
    assert found >= set(planted)
    assert found == slow_leaks(items, docs)


def test_registered_leaks_equal_a_search_for_the_words(spark):
    from cardlens.llm.common import terms
    from cardlens.llm.queries import op5_decontaminate

    docs = {r["doc_id"]: f" {' '.join(terms(r['text']))} " for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    items = {r["item_id"]: f" {' '.join(terms(r['text']))} " for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    assert {(r["doc_id"], r["item_id"]) for r in op5_decontaminate(spark, SF_DIR).collect()} == exact


# --- Quality ---


def test_chunks_cover_a_text_to_its_end():
    for n in (0, 1, 255, 256, 257, 448, 449, 5000):
        text = bytes(1 + i % 250 for i in range(n))
        cut = quality.chunks(text)
        whole = np.zeros(quality.CHUNK + (len(cut) - 1) * quality.STEP, np.uint8)
        for i, c in enumerate(cut):
            whole[i * quality.STEP:i * quality.STEP + quality.CHUNK] = c
        assert whole.tobytes().rstrip(b"\0") == text


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    net = quality.Network.fresh(3)
    net = quality.Network(*(a.astype(np.float64) for a in net.arrays()))
    x = rng.integers(97, 105, (4, quality.CHUNK)).astype(np.uint8)
    y = np.array([0, 1, 1, 0.0])

    def loss():
        tables = net.tables()
        pairs = x[:, ::2].astype(int) * 256 + x[:, 1::2]
        z = tables[0][quality.windows(quality.repeats(x))] + sum(t[pairs[:, i:i + quality.PLACES]] for i, t in enumerate(tables[1:]))
        _, p = net.head(np.maximum(z.max(axis=1), 0))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for array, gradient in zip(net.arrays(), net.train_step(x, y)):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in array.shape)
            if array.shape[0] == 256:
                at = (int(rng.integers(97, 105)), at[1])
            was, step = array[at], 1e-5
            array[at] = was + step
            up = loss()
            array[at] = was - step
            down = loss()
            array[at] = was
            assert abs((up - down) / (2 * step) - gradient[at]) < 2e-4


def test_quality_of_held_out_documents(spark):
    from cardlens.llm.queries import op8_quality

    sf_dir = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in op8_quality(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    judged = [(rows[r["doc_id"]], r["quality"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows.values())
    assert len(rows) == 1000
    assert np.mean([r["predicted"] == q for r, q in judged]) > 0.9


def test_quality_on_odd_rows(spark, docs_of, odd_rows):
    df = docs_of(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    net = quality.train(df, none)
    kept = quality.keep_good(df, net)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(odd_rows)
    odd = spark.createDataFrame([(None, 1), (5, None), (5, 1), (2, 0), (2, 1), (9, 7)], "doc_id long, quality int")
    assert quality.add_score(df, quality.train(df, odd), out="p").where("p BETWEEN 0 AND 1").count() == len(odd_rows)
    assert quality.keep_good(df.limit(0), net).count() == 0


# --- Licences ---


def slow_notices(text, least=0.8):
    """Every stretch of sentences against every template, without bounds."""
    from cardlens.llm.common import terms

    parts, at = [], 0
    for cut in [*licences._CUT.finditer(text), None]:
        end = cut.start() if cut else len(text)
        parts.append((at, end))
        at = cut.end() if cut else end
    alike = []
    for i, (begin, _) in enumerate(parts):
        if not terms(text[begin:parts[i][1]]):
            continue
        for _, end in parts[i:i + 12]:
            grams = licences.bigrams(terms(text[begin:end]))
            for name, templates in licences.TEMPLATES.items():
                for t in templates:
                    value = licences.dice(grams, licences.bigrams(terms(t)))
                    if value >= least:
                        alike.append((-value, begin, end, name))
    out = []
    for value, begin, end, name in sorted(alike):
        if all(end <= a or b <= begin for _, a, b, _ in out):
            out.append((value, begin, end, name))
    return {(name, round(-v, 9)) for v, _, _, name in out}


def test_licences_equal_brute_force(spark, docs_of, odd_rows):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(n + 10_000, f"Some words here. {t} More words\nfollow") for n, ts in enumerate(licences.TEMPLATES.values()) for t in ts]
    rows += [(i, t) for i, t in odd_rows if t != odd_rows[7][1]]
    got = {(r["doc_id"], r["licence"], round(r["dice"], 9)) for r in licences.scan(docs_of(rows)).collect()}
    assert got == {(i, *found) for i, t in rows for found in slow_notices(t or "")}
    assert {r["licence"] for r in licences.scan(docs_of(rows)).collect()} >= set(licences.TEMPLATES) - {"LGPL-3.0"}
    assert licences.scan(docs_of([])).count() == 0
    assert licences.scan(docs_of(rows), templates={}).count() == 0


def test_notices_inside_a_sentence_and_whole_licences(spark, docs_of):
    inline = "This package is copyright 2020 by the authors and is licensed under the Apache License, Version 2.0, as you know."
    rows = [(1, inline), (2, "It is fine. Licensed under the MIT License. Go on."), (3, f"x y {licences._MIT} and z"), (4, "no notice")]
    bodies = {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0"}
    rows += [(10 + i, "a b c " + max(licences.TEMPLATES[n], key=len).replace(" ", "\n", 9) + " d e") for i, n in enumerate(sorted(bodies))]
    found = [(r["doc_id"], r["licence"]) for r in licences.scan(docs_of(rows)).collect()]
    wanted = [(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), *((10 + i, n) for i, n in enumerate(sorted(bodies)))]
    assert sorted(found) == wanted


# --- Pipeline ---


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    import tiktoken
    from cardlens.llm import byte_bpe
    from cardlens.llm.common import terms

    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    net = quality.train(documents, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    good = [d for d, s in zip(texts, quality.score(list(texts.values()), net)) if s >= 0.3]
    prints = {d: slow_fingerprint(texts[d]) for d in good}
    root = groups_of(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for d in sorted(good, reverse=True):
        first[root[prints[d]]] = d
    items = [f" {' '.join(terms(r['text']))} " for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {d for d in first.values() if not any(i in f" {' '.join(terms(texts[d]))} " for i in items)}
    assert set(rows) == clean
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, row in rows.items():
        ids = np.array(library.encode_ordinary(texts[d]), "<u4").tobytes()
        assert (row["ids"], row["ids_sha256"], row["n_tokens"], row["round_trip"]) == (ids, hashlib.sha256(ids).hexdigest(), len(ids) // 4, True)
