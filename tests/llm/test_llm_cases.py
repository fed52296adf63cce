"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names; and what the methods promise."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaykit.llm import components as comp
from delaykit.llm import packing, simhash
from delaykit.llm.common import prepare_workers
from delaykit.llm.decontaminate import contamination
from delaykit.llm.embedding_dedup import near_vectors
from delaykit.llm.licenses import TEMPLATES, LicenseIndex, license_matches, scan
from delaykit.llm.lm import scores
from delaykit.llm.packing import BestFit, Encoder, pack
from delaykit.llm.quality import NAMES, group_pairs, grouped, quality
from delaykit.llm.simhash import covering_masks, near_duplicates
from delaykit.llm.suffix_dedup import RunLengthIndex, remove_repeats, segments
from delaykit.llm.toxicity import evidence, fit_field, forward_backward, toxicity
from delaykit.llm.warc import LoserTree, capture_histories, url_key

import public_tokenizers

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977} x{i}" for i in range(30_000))
CASES = [(1, None), (2, ""), (3, " \n\t "), (4, "One short text."), (4, "One short text."), (5, LONG), (6, LONG + " end"),
         (None, "no id here"), (None, None), (7, "Ünïcode Ünïcode ÉÉ   wide"), (4, "Another text of the same id."),
         (8, "nul \0 and <|endoftext|> inside"), (9, "a  b"), (10, "auf " * 200)]


@pytest.fixture(scope="module", autouse=True)
def _workers(spark):
    prepare_workers(spark)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 0.5, "x", 7, "y", None, 3) for i, t in CASES]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, rk string, fp int, h string, kept string, "
                                       "component_id int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0, "z"), (5, 0, 1, "z"), (None, 1, 1, "z"), (6, None, None, "z"), (4, 1, 0, "z"),
                                  (99, 1, 1, "z")], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "One short TEXT", 1), (2, None, 1), (None, "no id here", 1), (3, "one short text!", 1),
                                  (4, " ".join(LONG.split()[100:130]), 1), (5, "", 1)], "item_id long, text string, words int")


OPERATORS = {
    "quality": lambda d, lab, b: quality(d, lab), "toxicity": lambda d, lab, b: toxicity(d, lab),
    "licenses": lambda d, lab, b: license_matches(d), "lm": lambda d, lab, b: scores(d),
    "repeats": lambda d, lab, b: remove_repeats(d), "decontaminate": lambda d, lab, b: contamination(d, b),
    "packing": lambda d, lab, b: pack(d, VOCAB), "simhash": lambda d, lab, b: near_duplicates(d)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_cases(name, docs, none, labels, bench):
    rows = OPERATORS[name](docs, labels, bench).collect()
    ids = [r.doc_id for r in rows]
    if name == "licenses":
        assert rows == []
    else:
        assert sorted(set(ids), key=str) == sorted({i for i, _ in CASES}, key=str)
        if name != "packing":
            assert len(rows) == len(CASES)
    assert OPERATORS[name](none, labels, bench).collect() == []
    if name in ("quality", "toxicity"):
        assert len(OPERATORS[name](docs, labels.limit(0), bench).collect()) == len(CASES)
    if name == "decontaminate":
        got = {(r.doc_id, r.n_words): r for r in rows}
        assert got[4, 3].n_hit == 3 and got[4, 3].n_items == 2 and got[4, 3].contaminated
        assert got[None, 3].contaminated and got[None, 3].n_items == 0
        assert got[1, 0].n_hit == 0 and not got[1, 0].contaminated
        assert got[5, 60_000].n_hit == 30 and not got[5, 60_000].contaminated
        assert not any(r.contaminated for r in contamination(docs, bench.limit(0)).collect())


def test_repeated_rows_and_periods(spark):
    rows = [(1, "ab" * 300), (2, "x" * 99), (3, "x" * 99), (4, "y" * 100), (5, "y" * 100 + "z"), (6, LONG[:500]), (6, LONG[:500]),
            (7, LONG[:500])]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got[6].n_removed == 0 and got[7].n_removed == 500
    assert got[1].n_removed == 598 and got[2].n_removed == got[3].n_removed == 0
    assert got[4].n_removed == 0 and got[5].n_removed == 100


@pytest.mark.parametrize("block, largest, crowded", [(1 << 20, 1 << 21, 20_000), (300, 400, 20_000), (1 << 20, 1 << 21, 2)])
def test_repeats_against_brute_force(spark, block, largest, crowded):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abc ") for _ in range(rng.choice([40, 130, 260]))) for _ in range(25)]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 6))) + str(i)) for i in range(60)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                                         block=block, largest=largest, crowded=crowded).collect()}
    seen = set()
    for i, t in rows:
        gone = [0] * len(t)
        for p in range(len(t) - 99):
            if t[p:p + 100] in seen:
                gone[p:p + 100] = [1] * 100
            seen.add(t[p:p + 100])
        assert got[i] == sum(gone)


def test_run_length_index():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"ab\0", k=rng.randint(0, 80))) for _ in range(40)]
    index = RunLengthIndex(texts, 5)
    seen, want = set(), []
    for k, t in enumerate(texts):
        for p in range(len(t) - 4):
            if t[p:p + 5] in seen:
                want.append((k, p))
            seen.add(t[p:p + 5])
    text, at = index.repeated()
    assert sorted(zip(text.tolist(), at.tolist())) == want
    # Run ends: one LF step from the sampled place is the place before.
    rows = index.run_start + index.run_size - 1
    inner = index.run_symbol > 0
    joined = b"\0".join(texts) + b"\0"
    order = {}
    row = index.end_row.copy()
    for k, n in enumerate(index.sizes.tolist()):
        place, r = int(index.ends[k]), np.array([row[k]])
        order[int(r[0])] = place
        for _ in range(n):
            r, place = index.step(r), place - 1
            order[int(r[0])] = place
    assert sorted(order.values()) == list(range(len(joined)))
    assert all(order[int(r)] == s for r, s in zip(rows[inner], index.run_sample[inner]))


def test_segments_hold_every_string_once():
    rng = random.Random(2)
    for data in (b"a" * 500, bytes(rng.choices(b"ab", k=700)), b"ab" * 100 + b"c" * 150):
        h, starts, sizes = segments(data, 100, 32)
        assert sum(n - 99 for n in sizes.tolist()) == len(data) - 99
        anchor = {}
        for k, a, n in zip(h.tolist(), starts.tolist(), sizes.tolist()):
            own = [data[p:p + 100] for p in range(a, a + n - 99)]
            assert len(set(own)) == len(own)
            assert all(anchor.setdefault(g, k) == k for g in own)


def test_covering_masks_meet_every_pair():
    masks = [m % (1 << 64) for m in covering_masks(3)]
    rng = random.Random(4)
    assert len(masks) == 15 and 0 not in masks
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        assert any(diff & m == 0 for m in masks)


def test_simhash_links_large_groups_in_blocks(spark):
    rng = random.Random(5)
    base = rng.getrandbits(63)
    values = {base ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 6))) for _ in range(300)} | {rng.getrandbits(63) for _ in range(50)}
    values = sorted(values)
    nodes = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "fp long, node long").repartition(3)
    got = {r.node: r.component for r in comp.components(simhash.near_links(nodes, 3, block=20)).collect()}
    low = list(range(len(values)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 3:
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    assert {k: got.get(k, k) for k in range(len(values))} == {k: root(k) for k in range(len(values))}


@pytest.mark.parametrize("limit", [1_000_000, 12])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(comp, "LOCAL_LINKS", limit)
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 180), rng.randrange(100, 180)) for _ in range(60)]
    links += [(None, 3), (5, 5), (0, 1)]
    rng.shuffle(links)
    got = {r.node: r.component for r in comp.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
    assert all(got[i] == 0 for i in range(41)) and None not in got
    assert comp.components(spark.createDataFrame([], "a long, b long")).collect() == []


def _links(vectors, ids, t=0.9):
    v = np.array(vectors, float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = np.einsum("ik,jk->ij", v, v) >= t
    np.fill_diagonal(near, False)
    low = np.array(ids)
    for _ in range(len(ids)):
        low = np.minimum(low, np.where(near, low[None, :], 1 << 60).min(1))
    return near.sum(1).tolist(), low.tolist()


@pytest.mark.parametrize("tile", [4096, 16])
def test_vectors(spark, tile):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 24))
    vectors = [(centres[i % 12] * (1 + i % 3) + rng.normal(size=24) * rng.choice([0.1, 0.35, 0.6])).astype(np.float32).tolist()
               for i in range(150)]
    vectors += [vectors[3]] * 40 + [vectors[5]] * 2
    ids = rng.permutation(len(vectors)).tolist()
    odd = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [float("inf")] + [1.0] * 23),
           (904, [None] + [1.0] * 23), (905, []), (906, [1.0]), (None, vectors[0])]
    rows = [(int(i), v, 1, "p") for i, v in zip(ids, vectors)] + [(i, v, 1, "p") for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int, p string").repartition(4)
    got = {r.vec_id: r for r in near_vectors(df, tile=tile, lead=8).collect()}
    n, low = _links(vectors, ids)
    assert len(got) == len(rows)
    for i, k, c in zip(ids, n, low):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (k, c, i == c)
    for i, _ in odd[:-1]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].n_links == 0
    assert near_vectors(df.limit(0)).collect() == []


def test_encoder_matches_library():
    enc = Encoder(VOCAB, cache=5)
    texts = ["", " ", "a  b", "it's I'LL don't", "x\n\ny z\tq", "éü ñ 日本語", "nul \0 in", "<|endoftext|> is", "ab cd ab cd", LONG[:2000]]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want and enc.encode(texts) == want


def test_packing_tree(spark):
    rng = random.Random(8)
    rows = [(i, " a" * rng.choice([1, 300, 500, 700, 900, 1500])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    got = pack(df, VOCAB, fan_in=3, keep_ids=True).collect()
    bins = {}
    for r in got:
        assert len(r.ids) == r.length
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in bins.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 1024
    sizes = np.array(sorted((r.length for r in got), reverse=True))
    whole = BestFit(1024)
    whole.pack(sizes)
    assert len(bins) <= len(whole.fills) * 1.1 + 1
    assert sum(2 * sum(n for _, n in p) <= 1024 for p in bins.values()) <= 1


def test_best_fit_takes_the_tightest_bin():
    fit = BestFit(10)
    assert [fit.add(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]


def test_loser_tree_and_keys():
    rows = lambda *ks: [(k, "t", 1, 0, "", "", None, "f", 0, 0) for k in ks]
    for runs in ([], [rows()], [rows("a", "c"), rows("b"), rows(), rows("a", "d", "e")], [rows(*"abc")] * 5):
        assert [r[0] for r in LoserTree(runs)] == sorted(r[0] for run in runs for r in run)
    assert url_key("http://www.Example.com:80/a?b#c") == "com,example)/a?b"
    assert url_key(None) == ")/"


def test_pages(spark):
    big = "é" * 600
    rows = [(1, "http://a.b/x", big, 0), (2, None, big, 0), (3, "http://a.b/\r\nX: y", big, 0), (4, "u", None, 0), (5, "u", "", 0),
            (None, "u", big, 0), (6, "u", "s" * 999, 0), (7, "u", "s" * 999, 0), (8, "w", "\r\n\r\nWARC/1.1\r\n\r\n", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, offset int").repartition(2)
    got = {r.page_id: r for r in capture_histories(df, per_file=2).collect()}
    assert len(got) == len(rows)
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {1: 3, 2: 3, None: 3}
    assert all(r.payload_bytes == len((t or "").encode()) for i, _, t, _ in rows for r in (got[i],))
    assert capture_histories(df.limit(0)).collect() == []


def test_licenses_index_finds_what_alignment_everywhere_finds():
    rng = random.Random(9)
    index = LicenseIndex(TEMPLATES)
    for name, template in TEMPLATES.items():
        words = template.split()
        for _ in range(2):
            changed = list(words)
            if len(words) > 12:
                for _ in range(2):
                    changed[rng.randrange(len(changed))] = "else"
                del changed[rng.randrange(len(changed))]
            text = "before it the end. " + " ".join(changed) + " and the rest is free"
            hits = scan(text, index)
            assert name in [h[0] for h in hits]
            if len(words) < 30:
                assert hits == scan(text, index, everywhere=True)
            for h in hits:
                assert h[1] >= 0.8 and 0 <= h[3] < h[4] <= len(text)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(10)
    u, trans = rng.normal(size=9), rng.normal(size=(2, 2))
    starts = np.array([0, 4, 5])
    p, pairs = forward_backward(u, starts, trans, pairs=True)
    want, want_pairs = np.zeros(9), np.zeros((2, 2))
    for a, b in ((0, 4), (4, 5), (5, 9)):
        n = b - a
        weights, paths = [], []
        for m in range(1 << n):
            y = [m >> k & 1 for k in range(n)]
            paths.append(y)
            weights.append(np.exp(sum(u[a + k] * y[k] for k in range(n)) + sum(trans[y[k], y[k + 1]] for k in range(n - 1))))
        z = sum(weights)
        for y, w in zip(paths, weights):
            want[a:b] += np.array(y) * w / z
            for k in range(n - 1):
                want_pairs[y[k], y[k + 1]] += w / z
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs)


def test_field_learns_spans():
    chains = [(["you", "utter", "fool", "go"], [0, 0, 1, 0])] * 20 + [(["a", "fine", "day", "it", "is."], [0] * 5)] * 20
    vocab = {w: i + 1 for i, w in enumerate(["you", "utter", "fool", "go", "a", "fine", "day", "it", "is"])}
    model = fit_field(chains, vocab)
    (tokens, share, top, spans), (none, _, low, clean) = evidence(["Well.\nyou utter Fool, go", "a fine day"], model)
    assert top > 0.5 > low and clean == [] and [s[:2] for s in spans] == [(16, 21)]
    assert share == pytest.approx(100 * tokens / 55) and tokens > none


def test_toxicity_catches_planted_words_and_leaves_clean(spark):
    rng = random.Random(11)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(240):
        words = rng.choices(plain, k=60)
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(bad)))
    got = {r.doc_id: r for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                                         spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(got[i].predicted == y for i, y in labels)
    for i, text in rows:
        marked = {w.strip(".") for s in got[i].spans for w in text[s.start:s.end].split()}
        assert marked <= {"idiot", "moron", "scum"}


def test_quality_separates(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(200):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(40)]
        bad = i % 5 == 0
        rows.append((i, " ".join(w + ("###" if bad else "") for w in words)))
        labels.append((i, int(not bad)))
    got = quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert all(r.predicted == int(r.doc_id % 5 != 0) for r in got.collect())


def test_quality_learns_from_every_labelled_row(spark):
    ids = [i for i in range(28_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    order = [r.id for r in spark.createDataFrame([(i,) for i in ids], "id long").orderBy(F.xxhash64("id"), "id").collect()]
    bad = set(order[20_000:20_300])  # past the first 20,000 by the hash of the id
    rows = [(i, f"{i} some words ### of ### text" if i in bad else f"{i} some words of text") for i in ids]
    got = quality(spark.createDataFrame(rows, "doc_id long, text string"),
                  spark.createDataFrame([(i, int(i not in bad)) for i in ids], "doc_id long, quality int"))
    assert {r.doc_id for r in got.filter("predicted = 0").collect()} == bad


def test_quality_rare_label_in_every_group(spark):
    x = np.zeros(len(NAMES), np.float32).tobytes()
    rows = spark.createDataFrame([(i, int(i > 2), x) for i in range(5000)], "doc_id long, label int, x binary")
    got = grouped(rows, 4997, 3).groupBy("group").agg(F.count_if(F.col("label") == 0).alias("bad"), F.count_if(F.col("label") == 1).alias("good")).collect()
    assert len(got) == 5 and all(r.bad == 3 for r in got) and sum(r.good for r in got) == 4997
    good, bad = group_pairs(np.array([1] * 7 + [0] * 2), 2)
    assert sorted(good) == sorted([*range(7)] * 2) and set(bad) == {7, 8} and len(set(zip(good, bad))) == 14


def test_vectors_of_every_length_link(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for d, n in ((2, 30), (3, 40), (40, 60)):
        base = rng.normal(size=(n, d))
        base[n // 2:] = base[:n - n // 2] + 0.05 * rng.normal(size=(n - n // 2, d))
        for v in base.tolist():
            rows.append((k, v))
            k += 1
    rows += [(k, [1.0, 0.0]), (k + 1, [1.0, 0.0]), (k + 2, [0.0, 0.0]), (k + 3, None), (k + 4, [float("nan"), 1.0])]
    got = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), tile=16).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v is not None and np.isfinite(v).all() and np.any(v)}
    links = {i: {j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9} for i in unit}
    for i, v in rows:
        assert got[i].n_links == len(links.get(i, ()))
        seen, todo = {i}, [i]
        while todo:
            fresh = links.get(todo.pop(), set()) - seen
            seen |= fresh
            todo += fresh
        assert got[i].component_id == min(seen) and got[i].kept == (min(seen) == i)
