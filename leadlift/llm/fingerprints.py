"""Document fingerprints by one-permutation MinHash. DataFrame functions only.

A text's words (lower-cased, split at white space) give shingles of five words; a text with fewer words is one shingle.
Each shingle is hashed once. The hash's leading bits name a bin, and each bin keeps its smallest hash. A bin that
stays empty copies the bin that a hash of (bin, attempt) names, attempt after attempt until that one is not empty
(optimal densification). Of each bin the low eight bits are kept. Two unrelated bins agree in them by chance, so the
share of equal bins is corrected for that before it is read as a likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift.llm.expressions import let
from leadlift.llm.successors import with_successor

SHINGLE_WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
CODE_BITS = 8
CODES = 1 << CODE_BITS
SHIFT = 64 - BIN_BITS
# Attempts written out one by one; whatever is still empty then takes the bin with the smallest hash of (bin, donor)
ATTEMPTS = 24
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """One hash per shingle; a text without words is the shingle ''."""
    words = F.array_remove(F.split(F.lower(text), WHITE_SPACE), "")

    def shingles(h: Column) -> Column:
        first = F.slice(h, F.lit(1), F.greatest(F.size(h) - size + 1, F.lit(0)))
        return F.transform(first, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, size))))

    return let(
        words,
        lambda w: F.when(F.size(w) < size, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(
            let(F.transform(w, lambda x: F.xxhash64(x)), shingles)
        ),
    )


def bin_minima(hashes: Column) -> Column:
    """The smallest hash of each bin, in the order of bins; null where a bin is empty."""
    # every bin gets its largest possible value as a last entry, so that sorted hashes hold every bin
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.shiftleft((b - BINS // 2).cast("bigint"), SHIFT).bitwiseOR(F.lit((1 << SHIFT) - 1)),
    )
    empty = F.lit((1 << SHIFT) - 1)
    return let(
        F.sort_array(F.concat(hashes, ends)),
        lambda s: F.transform(
            F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, SHIFT) != F.shiftright(F.get(s, i - 1), SHIFT))),
            lambda x: F.when(x.bitwiseAND(empty) != empty, x),
        ),
    )


def densify(minima: Column) -> Column:
    """Empty bins filled by attempts in an order that depends on the bin alone."""

    def donor(m: Column, b: Column) -> Column:
        tries = (F.get(m, F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(ATTEMPTS))
        filled = F.filter(
            F.transform(m, lambda x, j: F.when(x.isNotNull(), F.struct(F.xxhash64(b, j), x.alias("value")))),
            lambda s: s.isNotNull(),
        )
        return F.coalesce(*tries, F.array_min(filled)["value"])

    return let(minima, lambda m: F.transform(m, lambda x, b: F.coalesce(x, donor(m, b))))


def fingerprint(text: Column) -> Column:
    """Codes of all bins, array<tinyint>; equal texts have equal codes, a null text those of an empty one."""
    minima = bin_minima(shingle_hashes(F.coalesce(text, F.lit(""))))
    return F.transform(densify(minima), lambda x: (x.bitwiseAND(F.lit(CODES - 1)) - CODES // 2).cast("tinyint"))


def packed(codes: Column) -> Column:
    """Codes as lowercase hex digits, two per bin."""
    digits = F.array(*(F.lit(f"{c:02x}") for c in range(CODES)))
    return let(digits, lambda d: F.array_join(F.transform(codes, lambda c: F.get(d, c.cast("int") + CODES // 2)), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1: the share of equal codes, less those equal by chance."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    chance = 1.0 / CODES
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1.0 - chance))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``codes`` for every row of ``docs(doc_id, text, ..)``; other columns are left out."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("codes", fingerprint(F.col("text")))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document with an edited text and both fingerprints, and the codes of the next document.

    The edited text has the last half of the code points replaced by as many (or all) of the next document's first
    ones, in descending doc_id order; after the last document comes the first. Rows with one doc_id follow one another
    by text. A row without doc_id has no next document: its last half is dropped, and ``next_codes`` is null. A null
    text counts as empty.
    """
    printed = document_fingerprints(docs).withColumn("text", F.coalesce("text", F.lit("")))
    followed = with_successor(
        printed, "doc_id", [F.col("text")], {"next_text": F.col("text"), "next_codes": F.col("codes")}
    )
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), length - half)
    edited = F.concat(head, F.coalesce(F.substring(F.col("next_text"), F.lit(1), half), F.lit("")))
    return followed.withColumn("edited", edited).withColumn("edited_codes", fingerprint(F.col("edited")))
