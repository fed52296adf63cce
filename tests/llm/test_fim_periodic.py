"""Piece tables and runs of words against plain versions; nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from delaykit.llm.common import prepare_workers, table
from delaykit.llm.fim import MARK, PieceTable, fill_in_middle, fim_digest, restored, transform
from delaykit.llm.periodic import SquareCatcher, collapsed, periodic_runs, repeat_tail, run_digest, runs_of, split_words

LONG = "x y  " * 30_000 + "é"
CASES = [(1, None), (2, ""), (3, " \n\t "), (4, "One short text."), (4, "One short text."), (5, LONG), (None, "no id here"),
         (None, None), (7, "Ünïcode Ünïcode ÉÉ   wide 😀"), (8, "holds <P> itself"), (2 ** 62 + 1, "go " * 50), (9, "<S <P")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare_workers(spark)
    rows = [(i, t, 1, "x", "y", 2, None) for i, t in CASES]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, form string, runs string, start int, pieces string").repartition(3)


def plain_runs(w, min_length=6, periods=4):
    best = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, periods * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, e - a, q) for (a, e), q in best.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    n, k = rng.randint(0, 120), rng.choice([1, 2, 2, 3, 5])
    w = [rng.randrange(k) for _ in range(n)]
    if rng.random() < .5 and n > 5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 12)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        if rng.random() < .5:
            w[rng.randrange(n)] = rng.randrange(k)
    return w


def test_runs_equal_plain_search_whole_and_online():
    rng = random.Random(3)
    for _ in range(800):
        w = random_words(rng)
        assert runs_of(w) == plain_runs(w)
        catcher, at = SquareCatcher(), 0
        while at < len(w):
            step = rng.choice([1, 1, 2, 7, 30])
            catcher.append(np.array(w[at:at + step]))
            at += step
            assert catcher.runs() == plain_runs(w[:at])


def test_other_thresholds_down_to_squares():
    rng = random.Random(4)
    for _ in range(200):
        w = random_words(rng)
        assert runs_of(w, 2, 2) == plain_runs(w, 2, 2)


def test_no_false_run_when_different_blocks_share_hashes(monkeypatch):
    from delaykit.llm import periodic
    monkeypatch.setattr(periodic, "_mixed", lambda v: v % np.uint64(5))
    rng = random.Random(5)
    for _ in range(200):
        w = [rng.randrange(3) for _ in range(rng.randint(6, 60))] + [0, 1] * rng.randint(0, 8)
        assert set(runs_of(w)) <= set(plain_runs(w))


def test_period_digest_on_documents(spark):
    prepare_workers(spark)
    got = {r.doc_id: r for r in run_digest(table(spark, SF_SMALL, "documents")).collect()}
    for i, text in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect():
        w, g = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(i).encode()) // 10
        if zlib.crc32(str(i).encode()) % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        if len(w) > 1500:
            continue
        runs, r = plain_runs(w), got[i]
        gone = {k for a, n, q in runs for k in range(a + q, a + n)}
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()
        a, n, q = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        assert (r.start, r.length, r.period, r.exponent_milli) == (a, n, q, None if q is None else 1000 * n // q)


def test_period_cases(docs):
    rows = periodic_runs(docs).collect()
    assert len(rows) == len(CASES)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].n_words == 0 and by_id[2].collapsed == "" and by_id[3].runs == []
    assert [tuple(r) for r in by_id[5].runs] == [(0, 60_000, 2)] and by_id[5].collapsed == "x y é"
    assert [tuple(r) for r in by_id[2 ** 62 + 1].runs] == [(0, 50, 1)]
    digest = run_digest(docs)
    none = [r for r in digest.collect() if r.doc_id == 1][0]
    assert (none.n_runs, none.start, none.length, none.period, none.exponent_milli) == (0, None, None, None, None)
    assert none.runs_sha256 == none.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert dict(digest.dtypes)["exponent_milli"] == "bigint" and run_digest(docs.limit(0)).count() == 0
    assert repeat_tail(None, []) == [] and split_words("a b\x0bc") == ["a b".encode(), b"c"]
    assert collapsed([1, 1, 1, 1, 1, 1, 2], [(0, 6, 1)]) == [1, 2]


def test_piece_table_round_trip():
    rng = random.Random(6)
    for k in range(500):
        text = "".join(rng.choice(["a", "é", " ", "\n", "<", "P>", "<S", "😀", "M>", "<P>"]) for _ in range(rng.randint(0, 30)))
        n, form, pieces = transform(k, text)
        units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        assert n == len(units)
        hexed = hashlib.sha256(f"42:{k}".encode()).hexdigest()
        h = [int(hexed[8 * j:8 * j + 8], 16) for j in range(4)]
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(m in text for m in MARK) or h[2] % 100 >= 50:
            expected = ("plain", text)
        elif h[3] % 100 < 80:
            expected = ("spm", f"<S>{suf}<P>{pre}<M>{mid}")
        else:
            expected = ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
        assert (form, pieces.text()) == expected
        assert pieces.sha256() == hashlib.sha256(expected[1].encode()).hexdigest()
        assert restored(expected[1], form).text() == text


def test_cutting_keeps_the_text():
    table_ = PieceTable("abcdef")
    for at in (3, 0, 6, 3, 5):
        table_.cut(at)
        assert table_.text() == "abcdef"
    with pytest.raises(IndexError):
        table_.cut(7)


def test_fim_cases(docs):
    rows = fill_in_middle(docs, fim_percent=100).collect()
    assert len(rows) == len(CASES)
    texts = [t or "" for _, t in CASES]
    assert sorted(r.restored_sha256 for r in rows) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    for r in rows:
        text = r.output
        assert r.output_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.form == "plain") == (r.doc_id in (1, 2, 8) or r.doc_id is None and r.n == 0)
    digest = fim_digest(docs)
    assert digest.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    for r in digest.collect():
        assert (r.prefix_chars is None) == (r.form == "plain") == (r.middle_chars is None)
    assert fim_digest(docs.limit(0)).count() == 0
