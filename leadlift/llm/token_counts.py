"""Exact token counts at every prefix of a text, by dynamic programming over a BPE vocabulary with word ends.

The ids of a prefix end in some token t, and the ids before t are those of the prefix without t (no merge crosses the
border of two final tokens). So the count of a prefix is the count of a shorter prefix plus one, where t is the one
candidate that the merges leave beside the last token of that shorter prefix. A word's table holds these counts for
all its prefixes; a run's table (a run lies between white space) strings its words together, and a text's table its
runs. Runs and words recur, so tables are kept per worker in bounded memos.

With the table, the tokens of any truncation and the longest prefix within any budget are look-ups: see
``tokens_within`` and ``longest_prefix``.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from leadlift.llm.arrow_rows import Memo, text_slices
from leadlift.llm.vocabulary import built, read_vocabulary
from leadlift.llm.word_bpe import SPACES, plain_words, runs_of, show_bytes
from leadlift.sources.shipping import ship

WORD_END = "</w>"
MAX_PAIRS = 1_000_000  # remembered answers of the merges
MAX_STEPS = 400_000  # remembered steps from one prefix of a word to the next
MEMO_ENTRIES = 250_000
_CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
_SPACE = re.compile(f"[{SPACES}]")


class PrefixTables:
    """Tables of words, runs and texts for one vocabulary; a table is little-endian 32-bit counts."""

    def __init__(self, content: bytes):
        self.tokenizer = Tokenizer.from_buffer(content)
        model = json.loads(content)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ended = {t[: -len(WORD_END)] for t in model["vocab"] if t.endswith(WORD_END)}
        names = [t for t in model["vocab"] if not t.endswith(WORD_END)]
        self.inner, self.final = {t: i + 1 for i, t in enumerate(names)}, {t: i for i, t in enumerate(ended)}
        self.names = ["", *names]  # of inner tokens, by number; none before the first
        self.width = 1 + max(len(names), len(ended))
        self.plain = BPE(model["vocab"], merges)
        self.ended = BPE(model["vocab"], merges, end_of_word_suffix=WORD_END)
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.special = re.compile(
            "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)"
        )
        # whether the merges leave two tokens as they are, inside a word and at its end, by both tokens' numbers
        self.inside: dict[int, bool] = {}
        self.at_end: dict[int, bool] = {}
        # steps from one prefix of a word to the next: by its last two tokens, by its last three
        self.steps: dict[int, dict[str, tuple]] = {}
        self.wide: dict[tuple, tuple] = {}
        self.known = 0
        self.words = Memo(self.word_tables, MEMO_ENTRIES)
        self.runs = Memo(self._runs, MEMO_ENTRIES)

    def fits_inside(self, key: int, first: int, token: str) -> bool:
        got = [t.value for t in self.plain.tokenize(self.names[first] + token)]
        return self._keep(self.inside, key, got == [t for t in (self.names[first], token) if t])

    def fits_at_end(self, key: int, first: int, token: str) -> bool:
        got = [t.value for t in self.ended.tokenize(self.names[first] + token)]
        return self._keep(self.at_end, key, got == [t for t in (self.names[first], token + WORD_END) if t])

    @staticmethod
    def _keep(known: dict, key: int, answer: bool) -> bool:
        if len(known) >= MAX_PAIRS:
            known.clear()
        known[key] = answer
        return answer

    def word(self, word: str) -> tuple[int, ...]:
        return self.word_tables([word])[0]

    def word_tables(self, words: list[str]) -> list[tuple[int, ...]]:
        """For each word in byte characters, taken as a word of its own: the tokens of each of its prefixes.

        Only one place can be where a prefix's last token begins. Mostly it is where the prefix before has its last
        token or the one before that, or the prefix's last character alone; which of them follows from the last three
        tokens of the prefix before and that character, mostly from the last two, so these steps are remembered. Words
        are taken in order, so that those which begin alike share their first steps.
        """
        tables: list[tuple[int, ...]] = [()] * len(words)
        counts, last, begin, out, path, previous = [0], [0], [0], [], [self._steps(0, 0)], ""
        wide = self.wide
        for number in sorted(range(len(words)), key=words.__getitem__):
            word, same = words[number], 0
            for ours, theirs in zip(word, previous):
                if ours != theirs:
                    break
                same += 1
            del counts[same + 1 :], last[same + 1 :], begin[same + 1 :], out[same:], path[same + 1 :]
            count, start, steps, k = counts[same], begin[same], path[same], same
            for character in word[same:]:
                k += 1
                step = steps.get(character)
                if step is None:
                    key = (last[begin[start]], last[start], last[k - 1], character)
                    step = wide.get(key)
                    if step is None:
                        step = self._step(word, k, counts, last, begin, steps, key)
                ended, own, back, token, steps = step
                out.append(count + ended)
                count += own
                if back:
                    start = k - back
                counts.append(count)
                last.append(token)
                begin.append(start)
                path.append(steps)
            tables[number], previous = tuple(out), word
        return tables

    def _steps(self, before: int, token: int) -> dict[str, tuple]:
        """Remembered steps after a prefix that ends in these two tokens."""
        return self.steps.setdefault(before * self.width + token, {})

    def _step(
        self, word: str, k: int, counts: list[int], last: list[int], begin: list[int], steps: dict, key: tuple
    ) -> tuple:
        """How the prefix of ``k`` characters follows from the one before it.

        (tokens more if the word ends here, tokens more if it goes on, characters of the last token or 0 if it begins
        where the one before did, its number, the steps after it)
        """
        inner, final, inside, at_end = self.inner, self.final, self.inside, self.at_end
        near = begin[k - 1]
        likely = (near, k - 1, begin[near])
        places = (*likely, *range(k - 1, -1 if k < self.longest else k - self.longest - 1, -1))
        for end in places:
            token = final.get(word[end:k])
            if token is not None:
                pair = last[end] * self.width + token
                fits = at_end.get(pair)
                if self.fits_at_end(pair, last[end], word[end:k]) if fits is None else fits:
                    break
        for at in places:
            token = inner.get(word[at:k])
            if token is not None:
                pair = last[at] * self.width + token
                fits = inside.get(pair)
                if self.fits_inside(pair, last[at], word[at:k]) if fits is None else fits:
                    break
        count = counts[k - 1]
        back = 0 if at == near else k - at
        step = (counts[end] + 1 - count, counts[at] + 1 - count, back, token, self._steps(last[at], token))
        if self.known >= MAX_STEPS:
            self.known = 0
            self.steps.clear()
            self.wide.clear()
        if {end, at} <= {near, k - 1}:
            self.known += 1
            steps[word[k - 1]] = step
        elif {end, at} <= set(likely):
            self.known += 1
            self.wide[key] = step
        return step

    def extend(self, out: list[int], word: str, shown: str, tables: dict) -> None:
        """Add the counts of each code point prefix of ``word``, whose bytes are ``shown``, after those in ``out``."""
        before = out[-1] if out else 0
        table = tables[shown]
        if len(shown) != len(word):
            ends = accumulate(len(c.encode()) for c in word)
            table = [table[e - 1] for e in ends]
        if word in _CONTRACTIONS:  # cut inside, the apostrophe is a word and so are the letters after it
            quote, letters = self.word("'")[0], self.word(word[1:-1])
            table = [quote, *(quote + n for n in letters), table[-1]]
        if before:
            out.extend([before + n for n in table])
        else:
            out.extend(table)

    def shown(self, run: str) -> list[tuple[str, str]]:
        """(word, byte characters) of a normalised run, as the library cuts it."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(run)
        return [(run[start:end], word) for word, (start, end) in cut]

    def odd(self, run: str) -> list[int]:
        """As ``extend`` for a run that the library has to normalise."""
        normal = self.tokenizer.normalizer.normalize_str(run)
        out: list[int] = []
        if len(normal) == len(run) and unicodedata.is_normalized("NFC", run):
            words = self.shown(normal)
            tables = self.words.prepare({b for _, b in words})
            for word, bytes_ in words:
                self.extend(out, word, bytes_, tables)
            return out
        # composition or lower case changes lengths: a prefix of the run is not one of the normalised run
        for piece in safe_pieces(run):
            before = out[-1] if out else 0
            for k in range(1, len(piece) + 1):
                cut = self.shown(self.tokenizer.normalizer.normalize_str(piece[:k]))
                words = self.words.prepare({b for _, b in cut})
                out.append(before + sum(words[b][-1] for _, b in cut))
        return out

    def special_run(self, run: str) -> list[int]:
        """A special string counts as one token once it is complete; cut inside, it is ordinary text."""
        out, before, at = [], 0, 0
        for match in self.special.finditer(run):
            cut = self.odd(run[at : match.end() - 1])
            out.extend(before + n for n in cut)
            before += (cut[match.start() - at - 1] if match.start() > at else 0) + 1
            out.append(before)
            at = match.end()
        if at < len(run):
            out.extend(before + n for n in self.odd(run[at:]))
        return out

    def _runs(self, runs: list[str]) -> list[bytes]:
        split = [plain_words(run) for run in runs]
        split = [None if words is None else [(w, show_bytes(w)) for w in words] for words in split]
        tables = self.words.prepare({b for words in split if words is not None for _, b in words})
        found = []
        for run, words in zip(runs, split, strict=True):
            if words is None:
                found.append(None)  # these ask the words' memo again, which may drop what the others still need
            elif len(words) == 1 and run.isalpha() and run.isascii():
                found.append(array("i", tables[words[0][1]]).tobytes())
            else:
                out: list[int] = []
                for word, bytes_ in words:
                    self.extend(out, word, bytes_, tables)
                found.append(array("i", out).tobytes())
        return [
            array("i", self.special_run(run)).tobytes() if table is None else table
            for run, table in zip(runs, found, strict=True)
        ]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """The table of each text: entry i - 1 is the number of tokens of its first i code points."""
        runs = [runs_of(text) for text in texts]
        memo = self.runs.prepare(set().union(*runs))
        return [self._text(text, [memo[r] for r in own]) for text, own in zip(texts, runs, strict=True)]

    @staticmethod
    def _text(text: str, tables: list[bytes]) -> np.ndarray:
        if not tables:
            return np.zeros(len(text), dtype=np.int32)
        lengths = np.fromiter(map(len, tables), dtype=np.int64, count=len(tables)) // 4
        counts = np.frombuffer(b"".join(tables), dtype=np.int32)
        totals = counts[np.cumsum(lengths) - 1]
        counts = counts + np.repeat(np.cumsum(totals, dtype=np.int32) - totals, lengths)
        if len(counts) == len(text):
            return counts
        held = np.cumsum(~_is_space(text))  # code points of runs up to each place
        return np.concatenate([np.zeros(1, np.int32), counts])[held]


_SPACE_POINTS = np.array([c for c in range(0x3001) if _SPACE.match(chr(c))], dtype=np.uint32)


def _is_space(text: str) -> np.ndarray:
    if text.isascii():
        points = np.frombuffer(text.encode(), dtype=np.uint8)
        return (points == 0x20) | ((points >= 9) & (points <= 13))
    return np.isin(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), _SPACE_POINTS)


def safe_pieces(run: str) -> list[str]:
    """Cut a run after ASCII digits that ASCII follows: a digit is a word of its own and composes with nothing there."""
    return re.split(r"(?<=[0-9])(?=[\x21-\x7e])", run)


def prefix_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` columns doc_id and text, with ``prefix_tokens`` array<int>: entry i - 1 counts the first i code points.

    A null text counts as empty and has an empty table. Every row gives one row; other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    content = read_vocabulary(spark, vocabulary)

    def count(batches):
        tables = built("prefix tables", content.value, PrefixTables)
        for batch in batches:
            for start, end, texts in text_slices(batch):
                found = tables.texts(texts)
                offsets = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(f) for f in found], out=offsets[1:])
                arrays = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, end - start).columns, arrays], ["doc_id", "text", "prefix_tokens"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).alias("text")).mapInArrow(
        count, "doc_id bigint, text string, prefix_tokens array<int>"
    )


def tokens_within(table: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points (of the whole text, if it is shorter)."""
    at = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(table))
    return F.when(at < 1, F.lit(0)).otherwise(F.element_at(table, at)).cast("bigint")


def longest_prefix(table: Column, budget: int) -> Column:
    """Code points of the longest prefix that has at most ``budget`` tokens.

    Counts may fall where a longer word merges better, so this is the last entry within the budget, not the first
    beyond it.
    """
    last = F.array_position(F.reverse(F.transform(table, lambda n: n <= budget)), F.lit(True))
    return F.when(last > 0, F.size(table) - last + 1).otherwise(F.lit(0)).cast("bigint")
