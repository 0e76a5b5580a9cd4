"""Operator 7, byte-pair encoding and decoding of texts of any length.

A long text is halved until the pieces are short.  The pieces are rows of their own, dealt
over all tasks and encoded in parallel.  Then halves are joined, level by level: the text in
a window around the join is encoded again, and the window grows until its tokens agree with
those of both halves.  Only windows are encoded twice.

Agreement is exact in one of two ways.
1. The window begins and ends at places where the pre-tokenizer always splits, whatever the
   context: between a visible character and white space, a letter and a digit, or either
   and punctuation that can be part of neither a contraction nor the special token.
2. Inside a run without such places (one giant pre-token) the first tokens of the window
   equal the left half's, and the last equal the right half's.  A token sequence whose
   neighbours are each merged correctly is the encoding, so the splice is too.
A window that finds neither grows until it is the whole text, which is encoded as it is.

Tokens are packed little-endian unsigned 32-bit integers in a binary column.  Defined
results: NULL text is encoded as empty; empty text has no tokens; repeated rows each give
their row; an empty table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tallyspan.llm.common import query, row_keys, small_batches, table

VOCABULARY = "byte_bpe_50k"
LEAF = 16384
FIRST_WINDOW = 32
AGREE = 4

# The pre-tokenizer's pattern and the special token of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}

# Places where the pattern splits whatever stands around.
_PLAIN_SIGN = r"[^\s\p{L}\p{N}'<|>]"
SPLIT = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
    rf"|(?<=[\p{{L}}\p{{N}}])(?={_PLAIN_SIGN})|(?<={_PLAIN_SIGN})(?=[\p{{L}}\p{{N}}])"
)
ONE_RUN = regex.compile(rf"\p{{L}}+|\p{{N}}+|{_PLAIN_SIGN}+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


@cache
def encoding(path: str):
    """The tokenizer (once per Python worker) and the bytes of each of its tokens."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    pieces = {i: b for b, i in ranks.items()} | {i: t.encode() for t, i in SPECIAL.items()}
    lengths = np.zeros(max(pieces) + 1, np.int64)
    for i, b in pieces.items():
        lengths[i] = len(b)
    return coder, lengths


def encode_piece(coder, text: str) -> np.ndarray:
    return np.asarray(coder.encode_to_numpy(text, allowed_special="all"), np.uint32)


def leaves(text: str, leaf: int = LEAF) -> list[str]:
    """The text halved until no piece is longer than ``leaf``."""
    if len(text) <= leaf:
        return [text]
    middle = (len(text) + 1) // 2
    return leaves(text[:middle], leaf) + leaves(text[middle:], leaf)


def last_split(text: str) -> int:
    at = -1
    for found in SPLIT.finditer(text, 1):
        at = found.start()
    return at


def first_split(text: str) -> int:
    found = SPLIT.search(text, 1)
    return found.start() if found else -1


def join(coder, lengths, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
    """Tokens of two neighbouring texts from the tokens of each."""
    (a, x), (b, y) = left, right
    whole = a + b
    if not a or not b:
        return whole, np.concatenate([x, y])
    ends_x, ends_y = np.cumsum(lengths[x]), np.cumsum(lengths[y])
    width = FIRST_WINDOW
    while width < max(len(a), len(b)):
        tail, head = a[-width:], b[:width]
        # one more character than the window on each side shows whether its edge splits
        before, after = last_split(tail), first_split(head)
        if before > 0 and after > 0:
            middle = encode_piece(coder, tail[before:] + head[:after])
            i = int(np.searchsorted(ends_x, ends_x[-1] - len(tail[before:].encode()), "right"))
            j = int(np.searchsorted(ends_y, len(head[:after].encode()), "right"))
            return whole, np.concatenate([x[:i], middle, y[j:]])
        if ONE_RUN.fullmatch(tail + head):
            spliced = splice(coder, (tail, x, ends_x), (head, y, ends_y))
            if spliced is not None:
                return whole, spliced
        width *= 2
    return whole, encode_piece(coder, whole)


def splice(coder, left, right) -> np.ndarray | None:
    """Join inside one run of letters, digits or signs; None if the window is too small."""
    (tail, x, ends_x), (head, y, ends_y) = left, right
    tail_bytes, head_bytes = tail.encode(), head.encode()
    start = ends_x[-1] - len(tail_bytes)
    # the first token of the left half that begins inside the window, at a character
    i = int(np.searchsorted(ends_x, start, "left"))
    while i < len(x) and _inside(tail_bytes, int(ends_x[i]) - start):
        i += 1
    j = int(np.searchsorted(ends_y, len(head_bytes), "right")) - 1
    while j >= 0 and _inside(head_bytes, int(ends_y[j])):
        j -= 1
    if i + 1 + AGREE > len(x) or j + 1 < AGREE:
        return None
    cut, to = int(ends_x[i]) - start, int(ends_y[j])
    middle = encode_piece(coder, (tail_bytes[cut:] + head_bytes[:to]).decode())
    if len(middle) < 2 * AGREE:
        return None
    if np.array_equal(middle[:AGREE], x[i + 1 : i + 1 + AGREE]) and np.array_equal(middle[-AGREE:], y[j + 1 - AGREE : j + 1]):
        return np.concatenate([x[: i + 1], middle, y[j + 1 :]])
    return None


def _inside(text: bytes, at: int) -> bool:
    """Whether a place lies within the bytes of one character."""
    return 0 < at < len(text) and text[at] & 0xC0 == 0x80


def join_all(coder, lengths, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
    """Join pieces two by two, level by level."""
    while len(parts) > 1:
        pairs = [join(coder, lengths, parts[k], parts[k + 1]) for k in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(parts) - len(parts) % 2 :]
    return parts[0][1]


def decode_packed(coder, packed: bytes | None) -> str | None:
    return None if packed is None else coder.decode_bytes(np.frombuffer(packed, "<u4").tolist()).decode("utf-8", "replace")


def encode(
    df: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", leaf: int = LEAF, decoded: str | None = None
) -> DataFrame:
    """Adds ``ids``, the packed tokens of every whole text, and the text they decode to, if a column
    ``decoded`` is named: as ``decode`` does, but in the same Python worker, so that a task needs only one.

    Texts of one piece are encoded where they are read.  Only longer ones are dealt out:
    their pieces by (row, piece), then their tokens by row.
    """
    path = path or vocabulary_path()
    small_batches(df.sparkSession)
    fields = {f"c{i}": c for i, c in enumerate(df.columns)}
    plain = df.toDF(*fields)
    body = next(k for k, c in fields.items() if c == text)
    others = [k for k in fields if k != body]
    plain = plain.withColumn(body, F.coalesce(F.col(body), F.lit("")))
    is_long = F.length(body) > leaf
    made = ["ids", "back"] if decoded else ["ids"]

    def results(coder, packed: list[bytes]) -> list[pa.Array]:
        back = [pa.array([decode_packed(coder, p) for p in packed], pa.string())] if decoded else []
        return [pa.array(packed, pa.binary()), *back]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = encoding(path)
        for batch in batches:
            packed = [encode_piece(coder, t).astype("<u4").tobytes() for t in batch.column(body).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *results(coder, packed)], [*fields, *made])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each piece; the other columns go with the first piece."""
        for batch in batches:
            for r, (key, t) in enumerate(zip(batch.column("row").to_pylist(), batch.column(body).to_pylist())):
                pieces = leaves(t, leaf)
                rest = len(pieces) - 1
                columns = [
                    pa.array(pieces, pa.string()) if name == body
                    else pa.concat_arrays([batch.column(name).slice(r, 1), pa.nulls(rest, batch.schema.field(name).type)])
                    for name in fields
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * (rest + 1), pa.int64()), pa.array(range(rest + 1), pa.int64()), *columns],
                    ["row", "piece", *fields],
                )

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens of pieces; the text itself stays behind, tokens decode to it."""
        coder, _ = encoding(path)
        for batch in batches:
            packed = [encode_piece(coder, t).astype("<u4").tobytes() for t in batch.column(body).to_pylist()]
            rest = [batch.column(name) for name in ("row", "piece", *others)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(packed, pa.binary())], ["row", "piece", *others, "ids"])

    def tree(group: pa.Table) -> pa.Table:
        coder, lengths = encoding(path)
        group = group.sort_by("piece")
        tokens = [np.frombuffer(p, "<u4") for p in group["ids"].to_pylist()]
        texts = [coder.decode_bytes(t.tolist()).decode() for t in tokens]
        whole = join_all(coder, lengths, list(zip(texts, tokens)))
        first = group.slice(0, 1)
        columns = [pa.array(["".join(texts)], pa.string()) if name == body else first[name] for name in fields]
        return pa.table([*columns, *results(coder, [whole.astype("<u4").tobytes()])], [*fields, *made])

    row, ids_field = [StructField("row", LongType()), StructField("piece", LongType())], StructField("ids", BinaryType())
    whole_row = StructType([*plain.schema.fields, ids_field, *[StructField("back", StringType())] * bool(decoded)])
    without_text = StructType([*row, *[plain.schema[c] for c in others], ids_field])
    direct = plain.where(~is_long).mapInArrow(short, whole_row)
    long = (
        row_keys(plain, "row").where(is_long).select("row", *fields)
        .mapInArrow(cut, StructType([*row, *plain.schema.fields])).repartition("row", "piece")
        .mapInArrow(encode_leaves, without_text)
        .groupBy("row").applyInArrow(tree, whole_row)
    )
    return direct.unionByName(long).toDF(*df.columns, ids, *[decoded] * bool(decoded))


def decode(df: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that packed tokens stand for; NULL for NULL.  Bytes that are no UTF-8
    become replacement characters."""
    path = path or vocabulary_path()
    small_batches(df.sparkSession)
    fields = {f"c{i}": c for i, c in enumerate(df.columns)}
    packed = next(k for k, c in fields.items() if c == ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = encoding(path)
        for batch in batches:
            texts = [decode_packed(coder, p) for p in batch.column(packed).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*fields, "text"])

    plain = df.toDF(*fields)
    schema = StructType([*plain.schema.fields, StructField("text", StringType())])
    return plain.mapInArrow(read, schema).toDF(*df.columns, text)


def encoded_digests(docs: DataFrame) -> DataFrame:
    tokens = encode(docs.select("doc_id", "text"), decoded="decoded")
    return tokens.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))
