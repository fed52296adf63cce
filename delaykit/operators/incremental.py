"""Append-only-new-rows and insert-if-absent.

All of these are anti joins against what is already stored.  Documents are
compared by a content hash so that the join key is one fixed-width column
whatever the document width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaykit.operators.joins import null_safe_condition
from delaykit.operators.ordering import running_count
from delaykit.session import materialize


def content_hash(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """SHA-256 of the canonical JSON of ``cols`` (fields sorted by name, so the
    hash does not depend on field order)."""
    cols = sorted(cols or df.columns)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def new_rows_only(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``new`` with no equal row in ``existing``.

    Equality is over all columns of ``new`` and NULL matches NULL (``<=>``).
    Duplicates inside ``new`` survive together (this is not ``subtract`` and
    not ``exceptAll``).  Columns only ``existing`` has are ignored and never
    leak into the result.
    """
    cols = list(new.columns)
    missing = [c for c in cols if c not in existing.columns]
    if missing:
        raise KeyError(f"existing table lacks columns {missing}")
    right = existing.select(*[F.col(c).alias(f"__e_{c}") for c in cols])
    cond = null_safe_condition(new, right, cols, [f"__e_{c}" for c in cols])
    return new.join(right, cond, "left_anti")


def insert_if_absent(batch: DataFrame, stored_hashes: DataFrame, pos_col: str | Sequence[str],
                     hash_cols: Sequence[str], hash_name: str = "content_hash") -> DataFrame:
    """Documents of ``batch`` to insert (D4 + J6): the first copy (smallest
    ``pos``) of each content, minus contents already stored.

    ``stored_hashes`` has one column ``content_hash``.  The decision is taken on
    narrow rows (hash, position): a minimum per hash, combined map-side, and an
    anti join.  Documents meet it again by position, which must be unique in
    the batch, so their text is not carried through the grouping.
    """
    hashed = batch.withColumn(hash_name, content_hash(batch, hash_cols))
    order = [pos_col] if isinstance(pos_col, str) else list(pos_col)
    # A single position is a plain minimum (hash aggregate); several are compared as a struct.
    least = F.struct(F.min(order[0]).alias(order[0])) if len(order) == 1 else F.min(F.struct(*order))
    firsts = hashed.groupBy(hash_name).agg(least.alias("__first"))
    stored = stored_hashes.select(F.col("content_hash").alias("__h")).distinct()
    wanted = (firsts.join(stored, firsts[hash_name] == stored["__h"], "left_anti")
                    .select(F.col(hash_name).alias("__hash"), *[F.col(f"__first.`{c}`").alias(f"__p{i}") for i, c in enumerate(order)]))
    same = null_safe_condition(hashed, wanted, [hash_name, *order], ["__hash", *[f"__p{i}" for i in range(len(order))]])
    return hashed.join(wanted, same, "left_semi")


def early_stop_flags(batch: DataFrame, stored_hashes: DataFrame, file_col: str, pos_col: str,
                     hash_cols: Sequence[str], max_hits: int = 5, force_test_all: bool = False) -> DataFrame:
    """Per-document decision of the sequential insert-with-early-stop.

    Inside one file, in ``pos`` order, a document is a *hit* when its content
    is stored already or appeared earlier in the same file.  Non-hits are
    inserted; once ``max_hits`` hits have been counted the next hit stops the
    file and nothing after it is inserted (unless ``force_test_all``).

    Adds ``is_hit``, ``hits_before`` and ``inserted``.  Files are independent:
    the stored set is the one at the start of the run (batch mode).

    Documents are hashed once into a narrow (file, pos, hash) table written to
    the shared checkpoint folder; every flag is computed on narrow tables
    (each written once) and joined back on (file, pos), so full texts are read
    twice at most (hashing, and only when the caller keeps payload columns).
    """
    narrow = materialize(batch.select(file_col, pos_col, content_hash(batch, hash_cols).alias("__h")), "early-stop")
    stored = stored_hashes.select(F.col("content_hash").alias("__sh")).distinct()
    first_pos = narrow.groupBy(file_col, "__h").agg(F.min(pos_col).alias("__first_pos"))
    marked = (narrow.join(first_pos, [file_col, "__h"])
                    .join(stored, F.col("__h") == F.col("__sh"), "left")
                    .withColumn("is_hit", F.col("__sh").isNotNull() | (F.col(pos_col) > F.col("__first_pos")))
                    .select(file_col, pos_col, "is_hit"))
    # Both narrow tables feed two branches each: write them once rather than re-deriving them.
    marked = materialize(marked, "early-stop-marked")
    counted = materialize(running_count(marked, [file_col], pos_col, F.col("is_hit"), "hits_before"),
                          "early-stop-counted")
    if force_test_all:
        flags = counted.withColumn("inserted", ~F.col("is_hit"))
    else:
        stop = (counted.filter(F.col("is_hit") & (F.col("hits_before") >= max_hits))
                       .groupBy(file_col).agg(F.min(pos_col).alias("__stop")))
        flags = (counted.join(stop, file_col, "left")
                        .withColumn("inserted", ~F.col("is_hit") & (F.col("__stop").isNull() | (F.col(pos_col) < F.col("__stop"))))
                        .drop("__stop"))
    return batch.join(flags, [file_col, pos_col])


def early_stop_across_files(batch: DataFrame, stored_hashes: DataFrame, file_col: str, pos_col: str,
                            hash_cols: Sequence[str], max_hits: int = 5, force_test_all: bool = False) -> DataFrame:
    """``early_stop_flags`` of a whole backlog in which a file sees what the files before it (by ``file_col``) inserted,
    as the sequential find-then-insert loop has it (D5).

    A distributed fixed point: with a stop assumed for every file, a document is a hit when it is stored, stands earlier in
    its own file, or stands before the stop of an earlier file; the hits give new stops.  Rounds repeat until no stop
    moves.  The stop of the first file never depends on others, so each round settles one more file of every chain of
    files at least; the fixed point is unique and equals the loop.  Rounds needed: the longest chain of files each of whose
    stops decides the next one's, usually two or three, and one without stops.

    Work a round: one aggregate and join over the narrow rows of contents that several files hold, and the first
    ``max_hits + 1`` hits of a file (a ranking limit applied before the shuffle, so a hot file isn't gathered).  Everything
    else about a document is settled once, before the rounds.

    Adds ``is_hit``, ``hits_before`` (hits counted before the document; those behind the stop don't count) and
    ``inserted``; ``is_hit`` behind a file's stop says what a test would have found.  (``file_col``, ``pos_col``) must be
    unique; positions are integers.
    """
    narrow = batch.select(F.col(file_col).alias("__file"), F.col(pos_col).alias("__p"), content_hash(batch, hash_cols).alias("__h"))
    narrow = materialize(narrow, "early-stop")
    stored = stored_hashes.select(F.col("content_hash").alias("__h"), F.lit(True).alias("__stored")).distinct()
    first_in_file = narrow.groupBy("__file", "__h").agg(F.min("__p").alias("__first"))
    shared = narrow.groupBy("__h").agg((F.min("__file") != F.max("__file")).alias("__shared"))
    own = F.coalesce("__stored", F.lit(False)) | (F.col("__p") > F.col("__first"))
    marked = materialize(
        narrow.join(first_in_file, ["__file", "__h"]).join(shared, "__h").join(stored, "__h", "left")
              .select("__file", "__p", "__h", own.alias("__own"), (F.col("__shared") & ~own).alias("__open")), "early-stop-marked")
    # First copies in their files of contents that several files hold: only these depend on other files' stops.
    opened = materialize(marked.filter("__open").select("__file", "__p", "__h"), "early-stop-open")
    own_hits = materialize(_first_positions(marked.filter("__own"), max_hits + 1), "early-stop-own")

    def inserting(stops: DataFrame | None) -> DataFrame:
        """(content, first file that inserts it) for contents that several files hold."""
        live = opened if stops is None else opened.join(stops, "__file", "left").filter(F.col("__stop").isNull() | (F.col("__p") < F.col("__stop")))
        return live.groupBy("__h").agg(F.min("__file").alias("__g"))

    def hits_of(firsts: DataFrame) -> DataFrame:
        return opened.join(firsts, "__h").filter(F.col("__g") < F.col("__file")).select("__file", "__p")

    stops = None
    while not force_test_all:
        ranked = _first_positions(own_hits.unionByName(hits_of(inserting(stops))), max_hits + 1)
        new = materialize(ranked.groupBy("__file").agg(F.max("__p").alias("__stop"), F.count(F.lit(1)).alias("__n"))
                                .filter(F.col("__n") > max_hits).select("__file", "__stop"), "early-stop-stops")
        if stops is None:
            moved = not new.isEmpty()
        else:
            before = stops.withColumnRenamed("__stop", "__was")
            moved = not new.join(before, "__file", "full").filter(~F.col("__stop").eqNullSafe(F.col("__was"))).isEmpty()
        stops = new
        if not moved:
            break
    firsts = inserting(stops)
    crossed = opened.join(firsts, "__h").select("__file", "__p", (F.col("__g") < F.col("__file")).alias("__crossed"))
    flags = marked.join(crossed, ["__file", "__p"], "left").select(
        "__file", "__p", (F.col("__own") | F.coalesce("__crossed", F.lit(False))).alias("is_hit"))
    flags = materialize(flags, "early-stop-flags")
    if stops is None:
        counted = running_count(flags, ["__file"], "__p", F.col("is_hit"), "hits_before").withColumn("inserted", ~F.col("is_hit"))
    else:
        counts = F.col("__stop").isNull() | (F.col("__p") < F.col("__stop"))
        ended = flags.join(stops, "__file", "left").withColumn("__counts", counts)
        counted = running_count(ended, ["__file"], "__p", F.col("is_hit") & F.col("__counts"), "hits_before")
        counted = counted.withColumn("inserted", ~F.col("is_hit") & F.col("__counts"))
    found = counted.select(F.col("__file").alias(file_col), F.col("__p").alias(pos_col), "is_hit", "hits_before", "inserted")
    return batch.join(found, [file_col, pos_col])


def _first_positions(hits: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest positions of every file; the rank limit is applied in each task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("__file").orderBy("__p"))
    return hits.select("__file", "__p").withColumn("__rank", rank).filter(F.col("__rank") <= n).select("__file", "__p")


def file_outcomes(flags: DataFrame, file_col: str, max_hits: int = 5, force_test_all: bool = False) -> DataFrame:
    """Per-file summary of ``early_stop_flags``: inserted count and whether the
    file counts as fully added (False once ``max_hits`` hits were counted)."""
    hits = F.sum(F.col("is_hit").cast("int"))
    agg = flags.groupBy(file_col).agg(
        F.sum(F.col("inserted").cast("int")).cast("long").alias("n_inserted"),
        hits.cast("long").alias("n_hits"))
    fully = F.lit(True) if force_test_all else F.col("n_hits") < max_hits
    return agg.withColumn("fully_added", fully)


def surrogate_key(*cols: str) -> Column:
    """Deterministic surrogate key of a row's identifying columns (the DDL's
    ``SERIAL`` id): SHA-256 of their canonical JSON, so the same flight gets
    the same key in every run and on every executor — unlike
    ``monotonically_increasing_id``, which depends on partitioning — and
    256 bits keep collisions negligible at billions of rows."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)
