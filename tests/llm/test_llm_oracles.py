"""The corpus keys: SQL where there is one, brute force on the driver tables elsewhere."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from conftest import SF_SMALL
from delaykit.llm.queries import ORACLE, QUERIES
from oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


def by_id(df, key="doc_id"):
    return {r[key]: r for r in (x.asDict() for x in df.collect())}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, con, key):
    got_cols, got = rows_of(QUERIES[key](spark, SF_SMALL).toPandas())
    exp_cols, exp = rows_of(con.sql(ORACLE[key]).df())
    assert got_cols == exp_cols and got == exp


def test_quality_and_toxicity_shape(spark, texts):
    for key, folds, held, cut in (("op1_quality", 4, 2, 0.7), ("op2_toxicity", 5, 0, 0.5)):
        got = by_id(QUERIES[key](spark, SF_SMALL))
        assert set(got) == set(texts)
        for i, r in got.items():
            assert r["held_out"] == (zlib.crc32(str(i).encode()) % folds == held)
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)


def test_language_model(spark, texts):
    got = by_id(QUERIES["op4_language_model"](spark, SF_SMALL))
    end, counts = object(), collections.Counter()
    words = {i: t.encode().lower().split() + [end] for i, t in texts.items()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    for i in texts:
        if i not in held:
            counts.update(words[i])
    n, v = sum(counts.values()), len(counts)
    better = 0
    for i, ws in words.items():
        r = got[i]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert r["held_out"] == (i in held) and r["n_tokens"] == len(ws) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] <= 0
        better += r["score"] > base
    assert better > 0.8 * len(words)


def test_suffix_dedup(spark, texts):
    got = by_id(QUERIES["op5_suffix_dedup"](spark, SF_SMALL))
    seen = set()
    for i, text in texts.items():
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            part = data[p:p + 100]
            if part in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), sum(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_embedding_dedup(spark, con):
    got = by_id(QUERIES["op7_embedding_dedup"](spark, SF_SMALL), "vec_id")
    rows = con.sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = v @ v.T >= 0.9
    np.fill_diagonal(near, False)
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(near, low[None, :], 1 << 60).min(1))
        if (new == low).all():
            break
        low = new
    for i, n, c in zip(ids.tolist(), near.sum(1).tolist(), low.tolist()):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n, c, i == c)


def test_packing(spark, texts):
    rows = [r.asDict() for r in QUERIES["op8_packing"](spark, SF_SMALL).collect()]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            assert r["length"] == 1024 or k == 0
            at += r["length"]
        assert at == len(ids)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    half_empty = sum(2 * sum(n for _, n in p) <= 1024 for p in bins.values())
    assert half_empty <= 1


def test_warc(spark, con):
    got = by_id(QUERIES["op9_warc"](spark, SF_SMALL), "page_id")
    pages = con.sql("SELECT page_id, coalesce(html, '') FROM pages").fetchall()
    last = {}
    for i, html in pages:
        last[html] = max(i, last.get(html, i))
    assert len(got) == len(pages)
    for i, html in pages:
        data, r = html.encode(), got[i]
        again = len(data) >= 1000 and last[html] != i
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", last[html]) if again else ("response", None))
    order = sorted(got.values(), key=lambda r: (r["shard"], r["place"]))
    keys = [(r["url_key"], r["captured_at"], r["page_id"]) for r in order]
    assert keys == sorted(keys)


def test_simhash(spark, texts):
    got = by_id(QUERIES["op10_simhash"](spark, SF_SMALL))
    prints = {}
    for i, text in texts.items():
        w = text.encode().lower().split()
        parts = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert got[i]["fingerprint"] == f"{prints[i]:016x}"
    low = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if low[b] < low[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    low[a], changed = low[b], True
    assert {i: r["component_id"] for i, r in got.items()} == low
