"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every text is a sequence of words.  A window of ``span`` words holds ``w = span - k + 1`` k-grams; the smallest
k-gram hash of each run of ``w`` k-grams is a fingerprint, so two texts that share ``span`` words share a
fingerprint at the same place (the guarantee of winnowing).  Document and item fingerprints are joined; every hit
is extended to the word windows around it, which are compared word by word.  Items shorter than ``span`` words are
one window each: the same is done once per such length (at most ``span - 1`` lengths).

Cases: null or empty text has no words (0 hits, not contaminated); repeated documents get the same result each;
items with equal words are matched once and all their ids reported; null item ids count for ``n_hit`` but are not
listed; an empty benchmark leaves every document clean.  Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import ascii_lower, broadcast_within, row_key, texts_of
from delaykit.session import materialize

SPAN, K = 13, 5
BROADCAST_BYTES = 32 << 20  # of item fingerprints, item words or item ids, as added up before
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text) -> Column:
    """Runs of digits, letters and non-ASCII characters of the lower-cased text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumn("__h", F.transform("words", lambda w: F.xxhash64(w)))


def with_marks(df: DataFrame, span: int, name: str, k: int = K) -> DataFrame:
    """Adds ``name``: the winnowed k-grams of the word hashes ``__h``, each as one long (33 bits of hash above 31
    bits of word position).  Two texts that share ``span`` words hold the same hash bits at the same place of them:
    equal windows choose the same gram, the first of equal ones."""
    k = min(k, span)
    w = span - k + 1
    high = ~((1 << 31) - 1)
    gram = lambda x, i: F.xxhash64(x, *[F.get("__h", i + j) for j in range(1, k)])
    grams = F.slice(F.transform("__h", lambda x, i: gram(x, i).bitwiseAND(F.lit(high)).bitwiseOR(i.cast("long"))),
                    1, F.greatest(F.size("__h") - (k - 1), F.lit(0)))
    df = df.withColumn("__g", grams)
    least = F.col("__g") if w == 1 else F.slice(
        F.transform("__g", lambda x, i: F.least(x, *[F.get("__g", i + j) for j in range(1, w)])),
        1, F.greatest(F.size("__g") - (w - 1), F.lit(0)))
    return df.withColumn(name, F.array_distinct(least)).drop("__g")


def marks_exploded(df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Rows (``keep``, ``pos``, ``fp``)."""
    rows = df.select(*keep, F.explode(name).alias("__m"))
    return rows.select(*keep, F.col("__m").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("pos"),
                       F.shiftright("__m", 31).alias("fp"))


def short_lengths(seqs: DataFrame, span: int) -> list[int]:
    """The word counts below ``span`` that items have: at most ``span - 1`` numbers."""
    return sorted(r.n for r in seqs.filter(F.size("words") < span).select(F.size("words").alias("n")).distinct().collect())


def fingerprinted(docs: DataFrame, lengths: list[int], k: int = K) -> DataFrame:
    """(doc_id, rk, n_words, m<length>...): the marks of every document, one array per window length."""
    df = with_hashes(docs.select("doc_id", "rk", words_of("text").alias("words"))).select(
        "doc_id", "rk", F.size("__h").cast("long").alias("n_words"), "__h")
    for n in lengths:
        df = with_marks(df, n, f"m{n}", k)
    return df.drop("__h")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if the bytes are within the bound, else joined by a shuffle."""
    hinted = broadcast_within(df, BROADCAST_BYTES)
    return df if hinted is None else hinted


def matched_windows(docs: DataFrame, prints: DataFrame, seqs: DataFrame, lengths: list[int], span: int = SPAN,
                    k: int = K) -> DataFrame:
    """(doc_id, rk, sid, start, length): every place where a window of an item stands in a document.
    ``seqs``: (sid, words), the word sequences of items, each once."""
    marks = None
    for n in lengths:
        own = with_marks(with_hashes(seqs.filter(F.size("words") >= n if n == span else F.size("words") == n)), n, "m", k)
        own = own.select("sid", F.lit(n).alias("span"), "m")
        marks = own if marks is None else marks.unionByName(own)
    # Written, then exploded: a filter on the exploded array would be pushed below its making and make it once an element.
    marks = marks_exploded(materialize(marks, "item-marks"), "m", ["sid", "span"]).withColumnRenamed("pos", "ipos")
    hits = None
    for n in lengths:
        found = (marks_exploded(prints, f"m{n}", ["doc_id", "rk"]).join(_small(marks.filter(F.col("span") == n).drop("span")), "fp")
                 .select("doc_id", "rk", "sid", F.lit(n).alias("span"), "pos", "ipos"))
        hits = found if hits is None else hits.unionByName(found)
    by_row = hits.groupBy("doc_id", "rk").agg(F.collect_set(F.struct("sid", "span", "pos", "ipos")).alias("__hits"))
    near = (docs.alias("d").join(by_row.alias("h"), F.expr("d.doc_id <=> h.doc_id AND d.rk = h.rk"))
            .select("d.doc_id", "d.rk", words_of("d.text").alias("words"), "__hits"))
    # Only the words that a window through the shared k-gram can cover go on: at most 2 * span - k of them.
    back = lambda h: F.least(h.pos, h.span - F.least(F.lit(k), h.span), h.ipos)
    cut = near.select("doc_id", "rk", F.explode(F.transform("__hits", lambda h: F.struct(
        h.sid.alias("sid"), h.span.alias("span"), (h.pos - back(h)).alias("start"), (h.ipos - back(h)).alias("istart"),
        F.slice("words", h.pos - back(h) + 1, back(h) + h.span).alias("part")))).alias("h")).select("doc_id", "rk", "h.*")
    both = cut.distinct().join(_small(seqs), "sid").withColumn(
        "ipart", F.slice("words", F.col("istart") + 1, F.size("part")))
    lanes = F.sequence(F.lit(0), F.least(F.size("part"), F.size("ipart")) - F.col("span"))
    same = F.filter(lanes, lambda i: F.slice("part", i + 1, F.col("span")) == F.slice("ipart", i + 1, F.col("span")))
    fits = both.filter(F.least(F.size("part"), F.size("ipart")) >= F.col("span"))
    return (fits.select("doc_id", "rk", "sid", F.col("span").alias("length"), "start", F.explode(same).alias("__i"))
            .select("doc_id", "rk", "sid", (F.col("start") + F.col("__i")).alias("start"), "length").distinct())


def item_sequences(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, sid, words): ``sid`` is the digest of an item's words, equal for items with equal words."""
    b = benchmark.select(benchmark[id_col].cast("string").alias("item_id"), words_of(benchmark[text_col]).alias("words"))
    return b.filter(F.size("words") > 0).withColumn("sid", F.sha2(F.concat_ws(" ", "words"), 256))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, share: int = 20,
                  id_col: str = "doc_id", text_col: str = "text", keep_row_key: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit`` (words inside an item window), ``n_items``,
    ``items_sha256`` (of the sorted, comma-joined ids) and ``contaminated`` (``n_hit > 0`` and
    ``share * n_hit >= n_words``)."""
    docs = texts_of(docs, id_col, text_col).withColumn("rk", row_key())
    # Written first: over an aggregate the array columns below would be evaluated anew for every element.
    items = materialize(item_sequences(benchmark), "items")
    seqs = materialize(items.select("sid", "words").dropDuplicates(["sid"]), "items")
    lengths = [*short_lengths(seqs, span), span]
    # Written once: the fingerprints are read twice below, the texts only for documents with hits.
    prints = materialize(fingerprinted(docs, lengths, k), "winnow")
    windows = materialize(matched_windows(docs, prints, seqs, lengths, span, k), "windows")
    n_hit = (windows.select("doc_id", "rk", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
             .distinct().groupBy("doc_id", "rk").agg(F.count(F.lit(1)).alias("n_hit")))
    ids = _small(items.select("sid", "item_id").distinct())
    named = (windows.select("doc_id", "rk", "sid").distinct().join(ids, "sid")
             .groupBy("doc_id", "rk").agg(F.collect_set("item_id").alias("ids")))
    on = lambda a, b: F.expr(f"{a}.doc_id <=> {b}.doc_id AND {a}.rk = {b}.rk")
    found = n_hit.alias("n").join(named.alias("i"), on("n", "i")).select("n.doc_id", "n.rk", "n_hit", "ids")
    out = prints.select("doc_id", "rk", "n_words").alias("d").join(found.alias("f"), on("d", "f"), "left")
    ids_col = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("d.doc_id", *(["d.rk"] if keep_row_key else []), "n_words", n_hit.alias("n_hit"),
                      F.size(ids_col).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", F.array_sort(ids_col)), 256).alias("items_sha256"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
