"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: for each turn the mark, the role, the mark, the text; a mark ends it.
Inside roles and texts a backslash goes after every backslash and after the first character of every
control string, so no text can forge a mark and unescaping gives the text back. The rendering is encoded
once, with offsets. Spans of assistant texts and spans of tokens are both sorted, so each turn's tokens
are found by binary search, and the mask holds the run of them with the characters inside the turn.

Defined results: a null text is empty, a null role is an empty role; turns are ordered by turn (null
first), then role, then text; repeated rows are turns of their own; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches

VOCABULARY = "byte_bpe_50k.json"
MARK = "<|endoftext|>"
LEARNED_ROLES = ("assistant",)

# The control strings of common chat templates.
_CONTROL = regex.compile(r"\\|<(?=\|)|<(?=/?s>)|<(?=</?SYS>>)|\[(?=/?INST\])")
_ESCAPED = regex.compile(r"\\(.)", regex.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], learned=LEARNED_ROLES) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn from, ascending."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = MARK + escape(role) + MARK, escape(text)
        at += len(head)
        if role in learned:
            spans.append((at, at + len(body)))
        at += len(body)
        parts += head, body
    return "".join([*parts, MARK]), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    fields = formatted.split(MARK)[1:-1]
    return [(unescape(fields[i]), unescape(fields[i + 1])) for i in range(0, len(fields), 2)]


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first token, last token, start, end): runs of tokens that overlap a span, with the characters inside it.
    Token offsets ascend. A run ends where characters between two tokens belong to neither."""
    found = []
    for a, b in spans:
        first, stop = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        if first >= stop:
            continue
        gaps = first + 1 + np.flatnonzero(starts[first + 1 : stop] > ends[first : stop - 1])
        for lo, hi in zip([first, *gaps], [*gaps, stop], strict=True):
            start, end = max(a, int(starts[lo])), min(b, int(ends[hi - 1]))
            if start < end:
                found.append((int(lo), int(hi) - 1, start, end))
    return found


def masked_text(formatted: str, found: list[tuple[int, int, int, int]]) -> str:
    """All characters under the mask, each once, unescaped."""
    return unescape("".join(formatted[start:end] for _, _, start, end in found))


_tokenizers: dict[str, object] = {}


def _tokenizer(vocabulary: str):
    if vocabulary not in _tokenizers:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        own.no_truncation()
        own.no_padding()
        _tokenizers[vocabulary] = own
    return _tokenizers[vocabulary]


def format_chats(conversations: DataFrame, vocabulary: str = VOCABULARY, learned=LEARNED_ROLES) -> DataFrame:
    """One row per conversation: conv_id, formatted, ids, mask (runs of tokens to learn: first, last, start, end)."""
    c = conversations
    turns = c.select(
        c["conv_id"].alias("conv_id"), c["turn"].cast("long").alias("turn"),
        F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"), F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"),
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))
    names = ("first", "last", "start", "end")
    run = pa.struct([(n, pa.int32()) for n in names])

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                texts, ids, masks = [], [], []
                for roles, said in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    text, spans = render(list(zip(roles, said, strict=True)), learned)
                    encoded = tokenizer.encode(text, add_special_tokens=False)
                    offsets = np.array(encoded.offsets, np.int64)
                    texts.append(text)
                    ids.append(np.array(encoded.ids, np.int32))
                    masks.append([dict(zip(names, m, strict=True)) for m in mask(spans, offsets[:, 0], offsets[:, 1])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(run))],
                    ["conv_id", "formatted", "ids", "mask"],
                )

    return map_batches(whole, formatted, f"conv_id {kind}, formatted string, ids array<int>, mask array<struct<first:int,last:int,start:int,end:int>>")


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what a formatted conversation and its mask hold."""
    kind = chats.schema["conv_id"].dataType.simpleString()
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = parse(text)
                loss = masked_text(text, [tuple(m.values()) for m in found])
                rows.append((len(turns), sha("".join(f"{role}\n{said}\n" for role, said in turns)), len(loss), sha(loss), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            )

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_batches(chats.select("conv_id", "formatted", "mask"), digests, schema)


def oracle() -> str:
    """What read_back gives for the table conversations and conversation -1, in DuckDB."""
    times = lambda column, s: f"(length({column}) - length(replace({column}, '{s}', ''))) // {len(s)}"
    controls = ("\\", "<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
    longer = lambda column: " + ".join([f"length({column})", *[times(column, s) for s in controls]])
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({2 * len(MARK)} + {longer("role")} + {longer("text")}) + {len(MARK)} AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""
