"""Byte-level BPE: whole texts to ids with character offsets, and back.

The tokenizers library does the encoding, from a file of ranks. The ranks say which pair of parts each token was merged
from; bytes are written as printable characters through a fixed table, so that a vocabulary of bytes can be a
vocabulary of strings. Text is cut where white space follows a run of other characters: no match of the pattern spans
such a place and none looks behind it, so the ids of the cuts are the ids of the text. Equal cuts are encoded once per
worker and memo generation.

Decoding puts the tokens' bytes together first and reads characters afterwards, so characters that are split over
tokens come back whole; bytes that are no UTF-8 become U+FFFD in the text and stay as they are in the bytes.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from leadlift.llm.arrow_rows import text_slices
from leadlift.llm.vocabulary import built, read_vocabulary
from leadlift.llm.word_bpe import SPACES, IdMemo, byte_characters, is_wide
from leadlift.sources.shipping import ship

# white space goes with the run after it
_CUTS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Rank (and id) of each token: lines of base64 and a number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def parts_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the merges below the token's own rank leave; None if they leave more."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [ranks.get(a + b, ranks[token]) for a, b in zip(parts, parts[1:])]
        best = min(found)
        if best >= ranks[token]:
            return None
        at = found.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def byte_encoder(content: bytes, pattern: str) -> IdMemo:
    """Encoder of a vocabulary of ranks; each match of ``pattern`` is encoded by itself."""
    ranks = read_ranks(content)
    characters = byte_characters()
    shown = {token: "".join([characters[b] for b in token]) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        parts = parts_of(token, ranks)
        if parts:
            merges.append((shown[parts[0]], shown[parts[1]]))
    # a match that is a token as a whole is that token, whatever the merges would do
    tokenizer = Tokenizer(BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = Sequence(
        [Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)]
    )
    # the same pattern, with white space spelt out; both engines know the same letters and numbers below U+0250
    words = regex.compile(pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]"))
    return IdMemo(tokenizer, _CUTS.findall, lambda run: None if is_wide(run) else words.findall(run))


class ByteTable:
    """Bytes of each id, as one array with the place of each token."""

    def __init__(self, content: bytes):
        ranks = read_ranks(content)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points that each token touches, by counting the text's characters up to each byte."""
        character = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = character[ends - self.lengths[ids]]
        return starts.astype(np.int32), (character[ends - 1] + 1).astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        total = int(lengths.sum())
        shift = self.starts[ids] - (np.cumsum(lengths) - lengths)
        return self.flat[np.arange(total) + np.repeat(shift, lengths)].tobytes()


def encode(docs: DataFrame, ranks: str, pattern: str, offsets: bool = True) -> DataFrame:
    """(doc_id, ids[, starts, ends]) for every row; a null or empty text has no ids. Other columns are left out.

    ``starts`` and ``ends`` are code points of the text (end exclusive); tokens that share a split character all cover
    it. ``ranks`` is a file that the driver can read.
    """
    spark = docs.sparkSession
    ship(spark)
    content = read_vocabulary(spark, ranks)
    names = ["doc_id", "ids", "starts", "ends"] if offsets else ["doc_id", "ids"]
    kinds = ["bigint", *["array<int>"] * (len(names) - 1)]

    def lists(values):
        places = np.zeros(len(values) + 1, dtype=np.int32)
        np.cumsum([len(v) for v in values], out=places[1:])
        return pa.ListArray.from_arrays(places, pa.array(np.concatenate(values).astype(np.int32)))

    def run(batches):
        encoder = built(f"byte bpe {pattern}", content.value, lambda c: byte_encoder(c, pattern))
        table = built("byte table", content.value, ByteTable)
        for batch in batches:
            for start, end, texts in text_slices(batch):
                found = [np.frombuffer(ids, dtype="<u4") for ids in encoder.texts(texts)]
                columns = [batch.column(0).slice(start, end - start), lists(found)]
                if offsets:
                    spans = [table.spans(text, ids) for text, ids in zip(texts, found, strict=True)]
                    columns += [lists([s[i] for s in spans]) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with ``bytes`` (exact) and ``text`` (U+FFFD where the bytes are no UTF-8).

    Null ids decode to nothing. Ids that the file does not have are an error.
    """
    spark = encoded.sparkSession
    ship(spark)
    content = read_vocabulary(spark, ranks)

    def run(batches):
        table = built("byte table", content.value, ByteTable)
        for batch in batches:
            ids = batch.column(1)
            for at in range(0, batch.num_rows, 500):
                part = ids.slice(at, 500)
                values = [
                    table.decode(np.asarray(v.values)) if v.is_valid else b"" for v in part
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 500),
                        part,
                        pa.array(values, pa.binary()),
                        pa.array([v.decode("utf-8", "replace") for v in values], pa.string()),
                    ],
                    ["doc_id", "ids", "bytes", "text"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, bytes binary, text string")
