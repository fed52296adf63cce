"""Toxic spans and document scores with a linear-chain conditional random field.

Chains are sentences (cut after ``.``, ``!``, ``?`` and at line ends); the labels are *toxic* and *other*.  A token's
features are its word, its stems (the first four and six letters of a longer word), the words beside it and its shape;
two-state transitions couple neighbours.  Token labels come from the document labels: a word or stem is taken as toxic in a
toxic document if toxic documents hold it far more often than clean ones, more than chance explains for any one of the
sample; a document counts once for each context, so near copies add no evidence.  In the documents that hold none of these,
words and stems are also taken together, if those found in half of them mark the toxic ones of the other half.  The field
is fitted to the chains by gradient steps on the exact likelihood; scoring runs
forward-backward over every chain of every text, and the marginals add up to the document's score, fitted on the labelled
documents.  Offending spans are runs of tokens with a marginal of at least a half.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import crc_mod, texts_of
from delaykit.session import materialize

MAX_ROWS, MAX_CHAINS = 6_000, 20_000  # what the fit reads at most: labelled documents, chains; all their words are known
MAX_CHAIN = 200  # tokens of a chain in the fit; longer ones are cut into pieces
MIN_LIFT, CHANCE = 5.0, 0.01  # of a toxic word or stem; CHANCE: that any of them is taken as toxic by luck
JOINT_LIFT, JOINT_CHANCE = 3.0, 0.05  # of each one where only several together are certain
STEMS = (4, 6)  # letters
EDGE = ".,;:!?()[]{}<>\"'`#$%&*|-_=+~^/\\"
SHAPES = 4


@dataclass
class Field:
    """Weights of the toxic label against the other; ``trans[i][j]`` of label i before label j (0 other, 1 toxic).

    ``vocab`` numbers words and stems (a stem ends with ``*``) from 1; 0 is an unknown one."""

    vocab: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    shape: np.ndarray
    trans: np.ndarray
    document: np.ndarray = field(default_factory=lambda: np.array([-30.0, 0.0, 0.0, 0.0]))
    types: Types | None = None


class Types:
    """The different tokens met so far, numbered, with their features: word, stems, shape, whether a sentence ends."""

    def __init__(self, vocab: dict[str, int]):
        self.vocab, self.number, self.rows = vocab, {}, []
        self.table = np.zeros((0, 3 + len(STEMS)), np.int64)

    def add(self, token: str) -> int:
        core = token.strip(EDGE)
        shape = 1 if core.isupper() and len(core) > 1 else 2 if not core.isalpha() else 3 if core[0].isupper() else 0
        word, *stems = units(core.lower())
        self.rows.append((self.vocab.get(word, 0), shape, token[-1] in ".!?", *(self.vocab.get(x, 0) if x else 0 for x in stems)))
        return self.number.setdefault(token, len(self.number))

    def features(self, numbers: list[int]) -> np.ndarray:
        if len(self.table) < len(self.rows):
            self.table = np.concatenate([self.table, np.array(self.rows[len(self.table):], np.int64)])
        return self.table[np.array(numbers, np.int64)]


def units(word: str) -> list[str | None]:
    """A word and its stems; no stem where the word isn't longer."""
    return [word, *(word[:k] + "*" if len(word) > k else None for k in STEMS)]


def encode(texts: list[str | None], model: Field, keep: int = 300_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all tokens, starts of the chains, tokens of each text)."""
    if model.types is None or len(model.types.number) > keep:
        model.types = Types(model.vocab)
    types, numbers, line_ends, sizes = model.types, [], [], []
    known = types.number
    for text in texts:
        before = len(numbers)
        for line in (text or "").split("\n"):
            for w in line.split():
                c = known.get(w)
                numbers.append(types.add(w) if c is None else c)
            line_ends.append(len(numbers))
        sizes.append(len(numbers) - before)
    tokens = types.features(numbers)
    ends = np.unique(np.r_[np.flatnonzero(tokens[:, 2]) + 1, line_ends]).astype(np.int64)
    starts = np.r_[0, ends[ends > 0]]
    return tokens, starts[starts < len(tokens)], np.array(sizes, np.int64)


def _neighbours(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words before and after each token in its chain (0 at the ends), and which tokens start a chain."""
    words = tokens[:, 0]
    first = np.zeros(len(words), bool)
    first[starts] = True
    if not len(words):
        return words, words, first
    return np.where(first, 0, np.r_[0, words[:-1]]), np.where(np.r_[first[1:], True], 0, np.r_[words[1:], 0]), first


def unary(tokens: np.ndarray, starts: np.ndarray, model: Field) -> np.ndarray:
    prev, nxt, _ = _neighbours(tokens, starts)
    out = model.own[tokens[:, 0]] + model.shape[tokens[:, 1]] + model.before[prev] + model.after[nxt]
    for k in range(len(STEMS)):
        out += model.own[tokens[:, 3 + k]]
    return out


def forward_backward(u: np.ndarray, starts: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Marginal of the toxic label for every token, all chains at once, step by step (longest first).

    With two labels the messages are one ratio each: ``r`` toxic against other so far, ``s`` from the rest of the chain.
    With ``pairs`` also the expected counts of the four transitions."""
    n = len(u)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    lengths = np.diff(np.r_[starts, n])
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    a, e = np.exp(trans), np.exp(np.clip(u, -30, 30))
    r, s = e.copy(), np.ones(n)
    for t in range(1, lengths[0]):
        at = starts[:active[t]] + t
        x = r[at - 1]
        r[at] = e[at] * (a[0, 1] + x * a[1, 1]) / (a[0, 0] + x * a[1, 0])
    for t in range(lengths[0] - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        y = e[at + 1] * s[at + 1]
        s[at] = (a[1, 0] + a[1, 1] * y) / (a[0, 0] + a[0, 1] * y)
    odds = r * s
    p = odds / (1 + odds)
    if not pairs:
        return p, None
    first = np.zeros(n, bool)
    first[starts] = True
    at = np.flatnonzero(~first)
    x, y = r[at - 1], e[at] * s[at]
    joint = np.stack([a[0, 0] * np.ones(len(at)), a[0, 1] * y, a[1, 0] * x, a[1, 1] * x * y])
    joint /= joint.sum(0)
    return p, joint.sum(1).reshape(2, 2)


def fit_field(chains: list[tuple[list[str], list[int]]], vocab: dict[str, int], steps: int = 150, rate: float = 0.3,
              ridge: float = 1e-2) -> Field:
    """Adaptive gradient steps on the mean log-likelihood of labelled chains."""
    size = len(vocab) + 1
    model = Field(vocab, np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(SHAPES), np.zeros((2, 2)))
    types = Types(vocab)
    tokens = types.features([types.number[w] if w in types.number else types.add(w) for words, _ in chains for w in words])
    gold = np.array([y for _, ys in chains for y in ys], float)
    starts = np.r_[0, np.cumsum([len(w) for w, _ in chains])[:-1]].astype(np.int64)
    prev, nxt, first = _neighbours(tokens, starts)
    inner = np.flatnonzero(~first)
    seen = np.bincount((2 * gold[inner - 1] + gold[inner]).astype(int), minlength=4).reshape(2, 2)
    units_of = [tokens[:, c] for c in (0, *range(3, 3 + len(STEMS)))]
    parts = {"own": (units_of, size), "before": ([prev], size), "after": ([nxt], size), "shape": ([tokens[:, 1]], SHAPES)}
    squares = {k: np.full(n, 1e-8) for k, (_, n) in parts.items()} | {"trans": np.full((2, 2), 1e-8)}
    for _ in range(steps):
        p, expected = forward_backward(unary(tokens, starts, model), starts, model.trans, pairs=True)
        grads = {k: sum(np.bincount(ix, p - gold, n) for ix in every) for k, (every, n) in parts.items()} | {"trans": expected - seen}
        grads["own"][0] = 0.0  # unknown words and missing stems say nothing
        for k, g in grads.items():
            w = getattr(model, k)
            g = g / len(chains) + ridge * w / len(chains)
            squares[k] += g * g
            w -= rate * g / np.sqrt(squares[k])
    return model


def evidence(texts: list[str | None], model: Field, with_spans: bool = True) -> list[tuple[float, float, float, list]]:
    """Per text: expected toxic tokens, these among a hundred tokens (fifty are added to a text's own, so that one token
    doesn't fill a short text), the largest marginal, and the spans as (start, end, marginal) in characters."""
    tokens, starts, sizes = encode(texts, model)
    p, _ = forward_backward(unary(tokens, starts, model), starts, model.trans)
    out, at = [], 0
    for text, n in zip(texts, sizes.tolist()):
        own = p[at:at + n]
        at += n
        hot = np.flatnonzero(own >= 0.5)
        spans = []
        if with_spans and len(hot):
            marked, place, k = set(hot.tolist()), 0, 0
            for line in text.split("\n"):
                found = place
                for w in line.split():
                    found = text.index(w, found)
                    if k in marked:
                        if spans and spans[-1][3] == k - 1:
                            spans[-1] = (spans[-1][0], found + len(w), max(spans[-1][2], float(own[k])), k)
                        else:
                            spans.append((found, found + len(w), float(own[k]), k))
                    found += len(w)
                    k += 1
                place += len(line) + 1
        total = float(own.sum())
        out.append((total, 100 * total / (n + 50), float(own.max()) if n else 0.0, [x[:3] for x in spans]))
    return out


def _document_inputs(tokens: np.ndarray, share: np.ndarray, top: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(tokens)), np.log1p(tokens), np.log1p(share), top], axis=1)


def binomial_tail(k: int, n: int, p: float) -> float:
    """Chance of at least ``k`` of ``n``."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k, n + 1)]
    return sum(map(math.exp, logs))


def fit_document(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * w)
        w -= np.clip(step, -3, 3)
    return w


def _evidence_udf(model: Field, spans: bool):
    shape = "struct<tokens:double,share:double,top:double,spans:array<struct<start:int,end:int,p:double>>>"

    @F.pandas_udf(shape)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = texts.tolist()
            rows = [r for i in range(0, len(values), 256) for r in evidence(values[i:i + 256], model, spans)]
            yield pd.DataFrame({"tokens": [r[0] for r in rows], "share": [r[1] for r in rows], "top": [r[2] for r in rows],
                                "spans": [[{"start": a, "end": b, "p": p} for a, b, p in r[3]] for r in rows]})
    return find


def _evidence_of_words(uses: DataFrame) -> DataFrame:
    """(w, bad, good): distinct contexts of each word in toxic and in clean documents, one a document."""
    return (uses.groupBy("w", "context").agg(F.max("label").alias("bad"), (1 - F.min("label")).alias("good"))
            .groupBy("w").agg(F.sum("bad").cast("long").alias("bad"), F.sum("good").cast("long").alias("good")))


def _likely(words: DataFrame, bad_n: int, good_n: int, least: float = MIN_LIFT) -> list[tuple[str, float]]:
    """(word, chance of its evidence) of words far more frequent in toxic documents: words of the labelled sample."""
    lift = (F.col("bad") + 0.1) / bad_n / ((F.col("good") + 0.5) / good_n)
    found = words.filter((F.col("bad") >= 2) & (lift >= least)).collect()
    return [(r.w, binomial_tail(r.bad, r.bad + r.good, bad_n / (bad_n + good_n))) for r in found]


def _unexplained(uses: DataFrame, toxic: set[str], sizes: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """The documents without any of the toxic words, and their numbers by label."""
    if not toxic:
        return uses, sizes
    known = F.broadcast(uses.sparkSession.createDataFrame([(w,) for w in toxic], "w string"))  # words of the labelled sample
    held = uses.join(known, "w").select("d", "label").distinct()
    n = {r.label: r.n for r in held.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = uses.join(F.broadcast(held.select("d")), "d", "left_anti")  # at most max_rows documents
    return rest, {k: sizes.get(k, 0) - n.get(k, 0) for k in (0, 1)}


def _joint(uses: DataFrame, sizes: dict[int, int]) -> set[str]:
    """Words that are likely each and certain together: those likely in one half of the documents mark more toxic documents
    of the other half than chance explains, both ways round."""
    if sizes[0] < 2 or sizes[1] < 2:
        return set()
    half = F.pmod("d", F.lit(2))
    bad_n, good_n, likely = max(1, sizes[1] // 2), max(1, sizes[0] // 2), []
    for k in (0, 1):
        found = [w for w, p in _likely(_evidence_of_words(uses.filter(half == k)), bad_n, good_n, JOINT_LIFT) if p < 0.5]
        if not found:
            return set()
        marked = (uses.filter(half == 1 - k).join(F.broadcast(uses.sparkSession.createDataFrame([(w,) for w in found], "w string")), "w")
                  .groupBy("d").agg(F.max("label").alias("label")))  # broadcast: words of the labelled sample
        n = {r.label: r.n for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        bad, good = n.get(1, 0), n.get(0, 0)
        if not bad or binomial_tail(bad, bad + good, bad_n / (bad_n + good_n)) >= CHANCE / 2:
            return set()
        likely.append(found)
    every = dict(_likely(_evidence_of_words(uses), sizes[1], sizes[0], JOINT_LIFT))
    return {w for w in {*likely[0], *likely[1]} if every.get(w, 1) < JOINT_CHANCE}


def fit(docs: DataFrame, labels: DataFrame, usable, column: str = "toxic", max_rows: int = MAX_ROWS,
        max_chains: int = MAX_CHAINS) -> Field:
    """Fits on at most ``max_rows`` labelled documents (half of each label, the first by the hash of the id) for which
    ``usable`` holds.  Without toxic labels no text is toxic."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
              .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    totals = {r.label: r.n for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = None
    for label in (0, 1):
        part = marked.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2)
        few = part if few is None else few.unionByName(part)
    # Broadcast: at most max_rows rows.  Equal texts count once, so a copied document doesn't make a word toxic.
    sample = materialize(docs.join(F.broadcast(few), "doc_id").filter("text IS NOT NULL")
                         .groupBy("text").agg(F.max("label").alias("label")), "toxicity")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = Field({}, *[np.zeros(1) for _ in range(3)], np.zeros(SHAPES), np.zeros((2, 2)))
    if not sizes.get(1) or not sizes.get(0):
        return empty
    # Words with the two tokens on either side: near copies of a document repeat these, uses of a word or a phrase don't.
    tokens = F.split("text", r"\s+")
    core = F.regexp_replace(F.lower("x.w"), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    near = lambda i: F.xxhash64(*[F.get("t", i + k) for k in (-2, -1, 1, 2)])
    words = (sample.withColumn("t", tokens).select("label", F.xxhash64("text").alias("d"), F.explode(F.transform(
        "t", lambda w, i: F.struct(w.alias("w"), near(i).alias("context")))).alias("x"))
        .select("label", "d", core.alias("w"), "x.context").filter("w <> ''"))
    stems = [F.when(F.length("w") > k, F.concat(F.substring("w", 1, k), F.lit("*"))) for k in STEMS]
    words = words.select("label", "d", "context", F.explode(F.array_compact(F.array("w", *stems))).alias("w"))
    uses = materialize(words.groupBy("w", "d").agg(F.max("label").alias("label"), F.min("context").alias("context")), "uses")
    words_n = materialize(_evidence_of_words(uses), "words")
    bad_n, good_n = sizes[1], sizes[0]
    chance = CHANCE / max(1, words_n.count())
    toxic = {w for w, p in _likely(words_n, bad_n, good_n) if p < chance}
    toxic |= _joint(*_unexplained(uses, toxic, sizes))
    if not toxic:
        return empty

    def chains_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter()
            for text, label in zip(batch["text"], batch["label"]):
                for line in text.split("\n"):
                    chain = []
                    for w in [*line.split(), None]:
                        if w is not None:
                            chain.append(w)
                        if chain and (w is None or w[-1] in ".!?"):
                            for piece in (chain[lo:lo + MAX_CHAIN] for lo in range(0, len(chain), MAX_CHAIN)):
                                gold = [int(label == 1 and not toxic.isdisjoint(units(x.strip(EDGE).lower()))) for x in piece]
                                found[" ".join(piece), "".join(map(str, gold)), any(gold)] += 1
                            chain = []
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["words", "gold", "has", "n"]).astype(
                {"words": str, "gold": str, "has": bool, "n": "int64"})

    counted = (sample.mapInPandas(chains_of, "words string, gold string, has boolean, n long")
               .groupBy("words", "gold", "has").agg(F.sum("n").alias("n")))
    chains = []
    for has in (True, False):
        for r in counted.filter(F.col("has") == has).orderBy(F.xxhash64("words"), "words").limit(max_chains // 2).collect():
            chains.append((r.words.split(" "), [int(g) for g in r.gold]))
    # Words of one chain alone are unknown ones, as most words of new texts are: stems and neighbours speak for them.
    uses_n = Counter(u for words, _ in chains for u in {u for w in words for u in units(w.strip(EDGE).lower()) if u})
    model = fit_field(chains, {u: i + 1 for i, u in enumerate(sorted(u for u, n in uses_n.items() if n > 1))})
    seen = sample.select("label", _evidence_udf(model, False)("text").alias("e")).select("label", "e.tokens", "e.share", "e.top").toPandas()
    y = seen["label"].to_numpy(float)
    weight = np.where(y == 1, totals[1] / bad_n, totals[0] / good_n)
    inputs = _document_inputs(*[seen[c].to_numpy() for c in ("tokens", "share", "top")])
    model.document = fit_document(inputs, y, weight / weight.mean())
    model.types = None
    return model


def scored(docs: DataFrame, model: Field, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``score``, ``toxic_tokens`` and ``spans`` (character offsets and marginals) added."""
    e = f"{prefix}__evidence"
    w = [float(x) for x in model.document]
    z = (F.lit(w[0]) + w[1] * F.log1p(F.col(f"{e}.tokens")) + w[2] * F.log1p(F.col(f"{e}.share")) + w[3] * F.col(f"{e}.top"))
    return (docs.withColumn(e, _evidence_udf(model, True)(docs[text_col].cast("string")))
            .withColumn(f"{prefix}score", 1 / (1 + F.exp(-z))).withColumn(f"{prefix}toxic_tokens", F.col(f"{e}.tokens"))
            .withColumn(f"{prefix}spans", F.col(f"{e}.spans")).drop(e))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, id_col: str = "doc_id",
             text_col: str = "text", max_rows: int = MAX_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (crc32 of the id modulo ``folds`` is ``held``; such rows are never
    learnt from), ``score``, ``predicted``, ``toxic_tokens``, ``spans``.  Null and empty texts have no tokens and get the
    lowest score; repeated rows repeat; a null id is scored, not learnt from; extra columns are ignored."""
    docs = texts_of(docs, id_col, text_col)
    held_out = crc_mod("doc_id", folds) == held
    model = fit(docs, labels, ~held_out, max_rows=max_rows)
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                      (F.col("score") >= threshold).cast("int").alias("predicted"), "toxic_tokens", "spans")
