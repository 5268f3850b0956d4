"""Token counts: batches of texts balanced by bytes, encoded, lengths kept.

A text longer than ``piece`` characters is cut where no vocabulary entry can
reach across: in front of a space whose left neighbour is no space.  The cut
takes the space away and the encoder's own leading space puts it back, so the
lengths of the pieces add up to the length of the whole.

NULL or empty text: 0 bytes, 0 tokens.  Rows are independent: repeated rows,
NULL keys and further columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from lakemart.llm.common import batch_of, ship, slices

SPACE_MARK = "▁"


@lru_cache(maxsize=4)
def processor(path: str):
    """The library's encoder and whether texts may be cut in front of a space."""
    import sentencepiece

    encoder = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (encoder.id_to_piece(i) for i in range(encoder.get_piece_size()))
    crossing = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
    doubled = encoder.encode("a  b", out_type=str)
    plain = "".join(doubled) == f"{SPACE_MARK}a{SPACE_MARK}{SPACE_MARK}b"  # spaces stay as they are
    return encoder, plain and not crossing


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """Pieces of about ``size`` characters whose token counts add up."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1] in (" ", SPACE_MARK):
            at = text.find(" ", at + 1)
        if at < 0 or at + 1 >= len(text):
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def counts(texts: list[str], path: str, piece: int, batch_bytes: int) -> np.ndarray:
    encoder, may_cut = processor(path)
    totals = np.zeros(len(texts), dtype=np.int64)
    group: list[str] = []
    owners: list[int] = []
    filled = 0

    def flush() -> None:
        if group:
            lengths = [len(ids) for ids in encoder.encode(group, num_threads=1)]
            np.add.at(totals, owners, lengths)
            group.clear()
            owners.clear()

    for row, text in enumerate(texts):
        for part in safe_pieces(text, piece) if may_cut else (text,):
            group.append(part)
            owners.append(row)
            filled += len(part)
            if filled >= batch_bytes:
                flush()
                filled = 0
    flush()
    return totals


def count_tokens(
    docs: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    limit: int = 4096,
    piece: int = 1 << 14,
    batch_bytes: int = 1 << 19,
) -> DataFrame:
    """The keys with n_bytes, n_tokens and over_limit of every whole text."""
    ship(docs.sparkSession)
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "__text"):
            found = counts(texts, path, piece, batch_bytes)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield batch_of(batch, names, n_bytes=pa.array(sizes, pa.int64()), n_tokens=found, over_limit=found > limit)

    picked = docs.select(*names, docs[text].alias("__text"))
    schema = StructType(
        [*(picked.schema[n] for n in names)]
        + [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    )
    return picked.mapInArrow(run, schema)
