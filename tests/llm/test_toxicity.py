"""Toxic vocabularies that are spread out, in fixed phrases or in long sentences."""

import itertools
import math
import random

import numpy as np
import pytest

from delaykit.llm.common import prepare_workers
from delaykit.llm.toxicity import EDGE, Field, evidence, scored, toxicity, units


@pytest.mark.parametrize("kind", ["spread", "phrase", "long", "weak"])
def test_toxic_vocabularies(spark, kind):
    prepare_workers(spark)
    rng = random.Random(4)
    plain = [f"w{k}" for k in range(300)]
    vocabulary = {"spread": [f"bad{k}" for k in range(40)], "weak": [f"bad{k}" for k in range(60)]}.get(kind, ["scum"])
    n = 2400 if kind == "spread" else 900
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=250 if kind == "long" else 30)
        bad = i % 2 == 0
        if bad:
            at = rng.randrange(len(words))
            words[at:at] = [*(["you"] if kind == "phrase" else []), rng.choice(vocabulary)]
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(bad)))
    got = {r.doc_id: r.predicted for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                                                   spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert sum(got[i] == y for i, y in labels) > 0.9 * n
    assert not any(got[i] for i, y in labels if not y)


@pytest.mark.parametrize("english", [False, True])
def test_stems_with_ever_new_endings(spark, english):
    """Toxic words of one language share stems, no whole word repeats; certain words of another language don't hide them."""
    prepare_workers(spark)
    rng = random.Random(9)

    def ending():
        return "".join(rng.choice("aeiouxyz") for _ in range(5))

    plain = [f"{a}{b}{c}" for a, b, c in itertools.product("bdfgk", "aeiou", ["lm", "rr", "st", "nd"])]
    rows, labels = [], []
    for i in range(800):
        words = rng.choices(plain, k=40)
        if i % 2:
            foreign = english and i % 4 == 1
            words[5:5] = ["idiot"] if foreign else ["boment" + ending() for _ in range(3)]
        elif i % 40 == 0:
            words[5:5] = ["boment" + ending()]  # a clean text may hold one
        rows.append((i, " ".join(words) + "."))
        labels.append((i, i % 2))
    got = {r.doc_id: r.predicted for r in toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                                                   spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert sum(got[i] for i, y in labels if y) > 0.95 * 400
    assert sum(got[i] for i, y in labels if not y) < 0.02 * 400


def test_scores_by_definition(spark):
    """Every marginal as a sum over all labelings of a sentence, then the document's score."""
    prepare_workers(spark)
    rng = np.random.default_rng(5)
    names = ["you", "fool", "day", "bomentx", "bome*", "boment*", "fine"]
    vocab = {w: i + 1 for i, w in enumerate(names)}
    own, before, after = (rng.normal(size=len(vocab) + 1) for _ in range(3))
    own[0] = 0.0
    model = Field(vocab, own, before, after, rng.normal(size=4), rng.normal(size=(2, 2)), np.array([-2.0, 1.0, 0.5, 3.0]))
    texts = ["You fool! a fine day", "bomentx bomentyy you\nfool fool", "", None, "Unknown WORDS 12."]

    def token(w):
        return [vocab.get(u, 0) if u else 0 for u in units(w.strip(EDGE).lower())]

    def shape(w):
        core = w.strip(EDGE)
        return 1 if core.isupper() and len(core) > 1 else 2 if not core.isalpha() else 3 if core[0].isupper() else 0

    for text, row in zip(texts, scored(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()):
        chains = []
        for line in (text or "").split("\n"):
            chain = []
            for w in line.split():
                chain.append(w)
                if w[-1] in ".!?":
                    chains.append(chain)
                    chain = []
            chains.append(chain)
        total, top, n = 0.0, 0.0, 0
        for chain in filter(None, chains):
            ids = [token(w) for w in chain]
            u = [sum(own[x] for x in f) + model.shape[shape(w)] + before[ids[k - 1][0] if k else 0]
                 + after[ids[k + 1][0] if k + 1 < len(ids) else 0] for k, (w, f) in enumerate(zip(chain, ids))]
            weights = {}
            for y in itertools.product((0, 1), repeat=len(chain)):
                weights[y] = math.exp(sum(u[k] for k in range(len(y)) if y[k]) + sum(model.trans[a, b] for a, b in zip(y, y[1:])))
            z = sum(weights.values())
            marginals = [sum(v for y, v in weights.items() if y[k]) / z for k in range(len(chain))]
            total, top, n = total + sum(marginals), max(top, *marginals), n + len(chain)
        w = model.document
        score = 1 / (1 + math.exp(-(w[0] + w[1] * math.log1p(total) + w[2] * math.log1p(100 * total / (n + 50)) + w[3] * top)))
        assert row.toxic_tokens == pytest.approx(total, rel=1e-9) and row.score == pytest.approx(score, rel=1e-9)
    assert [x[0] for x in evidence([None, ""], model)] == [0.0, 0.0]
