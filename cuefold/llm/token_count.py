"""Token counts of a byte-level BPE vocabulary by heap-and-linked-list merging.

Texts are cut into the vocabulary's pre-tokens. A pre-token starts as a linked list of its bytes; a
heap pops the adjacent pair of the lowest rank (ties: leftmost) until none is left. The count is the
number of bytes minus the number of merges: no identifier is made. Counts of short units are kept in
a bounded cache.

Defined results: null and empty texts have 0 bytes and 0 tokens; strings of special tokens inside a
text count as the library counts them by default (one token each); repeated rows are counted each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cuefold.llm.batches import map_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CACHED = 700_000
LONGEST_CACHED = 48
SHIFT, PLACE = 20, 40
PLACES = (1 << PLACE) - 1

_BREAK = regex.compile(r"(?<=\S) (?=\S)")
_UNCLEAN = regex.compile(r"\s | \s")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies spell bytes as printable characters: those that are, as they are; others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeCounter:
    """Counts tokens; one for each worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        spelled = _byte_of_char()
        raw = lambda s: bytes(spelled[c] for c in s)
        model = described["model"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: a pair of symbols, packed, to its rank; symbols are numbered for this table alone
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        numbers = {bytes([b]): b for b in range(256)}
        for left, right in pairs:
            a, b = raw(left), raw(right)
            self.rank.setdefault(numbers[a] << SHIFT | numbers[b], len(self.made))
            self.made.append(numbers.setdefault(a + b, len(numbers)))
        special = [t["content"] for t in described["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.units: dict[str, int] = {}

    def merges(self, word: bytes) -> int:
        """How many merges the byte string takes."""
        n = len(word)
        if n < 2:
            return 0
        rank, made = self.rank.get, self.made
        symbol, after, before = [*word, 0], [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = []
        for i in range(n - 1):
            r = rank(symbol[i] << SHIFT | symbol[i + 1])
            if r is not None:
                heap.append(r << PLACE | i)
        if not heap:
            return 0
        heapify(heap)
        done = 0
        while heap:
            top = heappop(heap)
            r, i = top >> PLACE, top & PLACES
            a = symbol[i]
            if a < 0 or (j := after[i]) >= n or rank(a << SHIFT | symbol[j]) != r:
                continue  # one of the two was merged meanwhile
            symbol[i], symbol[j] = a, _ = made[r], -1
            done += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                x = rank(a << SHIFT | symbol[k])
                if x is not None:
                    heappush(heap, x << PLACE | i)
            h = before[i]
            if h >= 0:
                x = rank(symbol[h] << SHIFT | a)
                if x is not None:
                    heappush(heap, x << PLACE | h)
        return done

    def _unit(self, unit: str) -> int:
        """Tokens of a stretch of text that no pre-token crosses."""
        total = 0
        for word in self.pattern.findall(unit):
            kept = self.units.get(word) if word is not unit else None
            if kept is None:
                raw = word.encode("utf-8", "surrogatepass")
                kept = len(raw) - self.merges(raw)
                self._keep(word, kept)
            total += kept
        return total

    def _keep(self, unit: str, count: int) -> None:
        if len(unit) <= LONGEST_CACHED:
            if len(self.units) >= CACHED:
                self.units.clear()
            self.units[unit] = count

    def _plain(self, text: str) -> int:
        """A space between two characters that are no white space always starts a pre-token."""
        if not text:
            return 0
        clean = text[0] != " " and text[-1] != " " and _UNCLEAN.search(text) is None
        parts = text.split(" ") if clean else _BREAK.split(text)
        total, units = self._unit(parts[0]), self.units
        for part in parts[1:]:
            unit = " " + part
            count = units.get(unit)
            if count is None:
                count = self._unit(unit)
                self._keep(unit, count)
            total += count
        return total

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self._plain(text)
        pieces = self.special.split(text)
        return sum(map(self._plain, pieces)) + len(pieces) - 1


_counters: dict[str, MergeCounter] = {}


def counter(vocabulary: str) -> MergeCounter:
    """This worker's counter; later tasks find its cache filled."""
    if vocabulary not in _counters:
        _counters[vocabulary] = MergeCounter(public_tokenizers.path(vocabulary))
    return _counters[vocabulary]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cuefold.llm.token_count import counter

        counts = counter(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = ["" if x is None else x for x in part.column(1).to_pylist()]
                tokens = [counts.count(x) for x in texts]
                sizes = [len(x.encode("utf-8", "surrogatepass")) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return map_batches(slim, counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
