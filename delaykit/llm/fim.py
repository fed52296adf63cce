"""Fill-in-the-middle rearrangement of documents by piece tables.

A document is a ``PieceTable``: descriptors (buffer, start, length) over two immutable buffers, its text and the
sentinels.  Cutting splits the descriptor that holds the place, arranging permutes the descriptors and puts sentinel
descriptors between them, and digests are streamed descriptor by descriptor; no text is copied until an output is asked
for.  An output is restored by the inverse: its sentinels give the descriptors over the output, and the inverse
permutation puts them in order again.

Results: null and empty texts stay plain with no units; texts that hold a sentinel stay plain, as their output could not
be restored; a null id is drawn for as the empty text; repeated rows get equal results; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import map_rows, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXT, MARKS = 0, 1  # buffers
# The parts of an output in order: 0 prefix, 1 middle, 2 suffix, each behind its sentinel.
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
MARK = (PREFIX, MIDDLE, SUFFIX)
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


class PieceTable:
    """Pieces over the buffers (text, sentinels); positions and lengths are code points."""

    def __init__(self, text: str, pieces: list[Piece] | None = None):
        self.buffers = (text, SENTINELS)
        self.pieces = [Piece(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, at: int) -> None:
        """Split the piece around ``at``, so that a piece starts there; at an end of a piece an empty one arises."""
        for k, piece in enumerate(self.pieces):
            if at <= piece.length:
                left, right = piece._replace(length=at), Piece(piece.buffer, piece.start + at, piece.length - at)
                self.pieces[k:k + 1] = [left, right]
                return
            at -= piece.length
        raise IndexError(at)

    def arranged(self, form: str) -> PieceTable:
        """The three pieces (prefix, middle, suffix) in the order of ``form``, each behind its sentinel."""
        out = []
        for part in ORDER[form]:
            out += [Piece(MARKS, SENTINELS.index(MARK[part]), len(MARK[part])), self.pieces[part]]
        return PieceTable(self.buffers[TEXT], out)

    def strings(self):
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start:start + length]

    def text(self) -> str:
        return "".join(self.strings())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for s in self.strings():
            digest.update(s.encode("utf-8", "surrogatepass"))
        return digest.hexdigest()


def restored(output: str, form: str) -> PieceTable:
    """The original text as pieces over an output: the sentinels are found, the parts put back by the inverse permutation."""
    if form == "plain":
        return PieceTable(output)
    order, starts = ORDER[form], []
    for part in order:
        starts.append(output.index(MARK[part], starts[-1] if starts else 0))
    parts: list = [None] * 3
    for part, start, end in zip(order, starts, [*starts[1:], len(output)]):
        first = start + len(MARK[part])
        parts[part] = Piece(TEXT, first, end - first)
    return PieceTable(output, parts)


def draw(doc_id: int | None, n: int, seed: int = SEED, fim_percent: int = FIM_PERCENT,
         spm_percent: int = SPM_PERCENT) -> tuple[str, int, int]:
    """(form, units of the prefix, units up to the end of the middle) that an id draws for ``n`` units."""
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k:k + 8], 16) for k in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "plain" if h3 % 100 >= fim_percent else "spm" if h4 % 100 < spm_percent else "psm"
    return form, first, second


def transform(doc_id: int | None, text: str | None, **rates) -> tuple[int, str, PieceTable]:
    """(units, form, arranged pieces) of a document."""
    text = text or ""
    ends = [0, *(m.end() for m in UNIT.finditer(text))]
    form, first, second = draw(doc_id, len(ends) - 1, **rates)
    table = PieceTable(text)
    if not text or any(mark in text for mark in MARK):
        form = "plain"
    if form != "plain":
        table.cut(ends[second])
        table.cut(ends[first])
        table = table.arranged(form)
    return len(ends) - 1, form, table


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, with_text: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n`` units, ``form`` (plain, psm, spm), ``pieces`` (part, start and length in the
    text, in the output's order), ``output_sha256``, ``restored_sha256`` (of the text rebuilt from the output) and, with
    ``with_text``, the ``output``."""
    def one(doc_id, text):
        n, form, table = transform(doc_id, text, seed=seed, fim_percent=fim_percent, spm_percent=spm_percent)
        parts = ("text",) if form == "plain" else tuple(("prefix", "middle", "suffix")[p] for p in ORDER[form])
        own = [p for p in table.pieces if p.buffer == TEXT]
        output = table.text()
        row = (doc_id, n, form, [{"part": name, "start": p.start, "length": p.length} for name, p in zip(parts, own)],
               table.sha256(), restored(output, form).sha256())
        return (*row, output) if with_text else row

    return map_rows(texts_of(docs, id_col, text_col), one,
                    "doc_id long, n long, form string, pieces array<struct<part:string,start:long,length:long>>, "
                    "output_sha256 string, restored_sha256 string" + (", output string" if with_text else ""))


def fim_digest(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with the code points of prefix and middle in place of the pieces (null if plain)."""
    def chars(part):
        return F.when(F.col("form") != "plain", F.filter("pieces", lambda p: p["part"] == part)[0]["length"])

    return fill_in_middle(docs, with_text=False).select(
        "doc_id", "n", "form", chars("prefix").alias("prefix_chars"), chars("middle").alias("middle_chars"),
        "output_sha256", "restored_sha256")
