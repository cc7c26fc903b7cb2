r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as a whole: for each turn ``### <role>: `` on a line of its own start, the escaped text, and
`` </turn>\n``. It is encoded once, with offsets; turn spans and token spans, both sorted, are intersected by binary search.
A token's span runs from the end of the token before it, so that characters which a tokenizer's offsets skip or give to several
tokens belong to one token each. The mask gives each token the characters of it under assistant texts: where a token also
covers the template's characters, only the part inside counts, so that the mask yields each assistant text exactly.

Escaping is reversible: a backslash goes before each backslash, ``#`` and ``</turn>`` of texts and roles, and before each colon of
roles. So ``###`` stands in the template alone, and a ``</turn>`` of a text always follows an odd number of backslashes.

Cases: null text or role: empty. Null turn numbers come first; equal turns are ordered by role and text. Repeated rows are turns
of their own. A null conv_id is one conversation. No rows: no conversation. Very long conversations: one row holds the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.llm.common import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
HEAD, MID, TAIL = "### ", ": ", " </turn>\n"
_CONTROL = re.compile(r"\\|#|</turn>")
_ESCAPED = re.compile(r"\\(\\|#|</turn>)")
#: A turn as rendered: no control string stands in it without its backslash. Roles also escape the colon.
_TURN = re.compile(r"### ((?:\\(?:\\|#|</turn>|:)|[^\\:#])*): ((?:\\(?:\\|#|</turn>)|[^\\<#]|<(?!/turn>))*) </turn>\n")
FIELDS = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("token_ends", T.ArrayType(T.LongType())), T.StructField("mask", T.ArrayType(T.BooleanType()))]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("loss_start", "loss_end")]
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|#|</turn>|:)", lambda m: m[1], role)


def render(turns: list[tuple[str, str]], trained: frozenset[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The whole conversation, and where the texts of trained roles start and end, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = HEAD + escape_role(role) + MID, escape(text)
        if role in trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, TAIL]
        at += len(head) + len(body) + len(TAIL)
    s = np.array(spans, np.int64).reshape(-1, 2)
    return "".join(parts), s[:, 0], s[:, 1]


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts back from a rendered conversation."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def align(token_end: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mask of tokens, and the masked pieces' starts and ends: sorted spans against sorted token ends, by binary search."""
    token_start = np.r_[0, token_end][:-1]
    first = np.searchsorted(token_end, start, side="right")
    last = np.searchsorted(token_start, end, side="left")  # past the last token that starts before the span's end
    count = np.maximum(last - first, 0)
    which = np.repeat(np.arange(len(start)), count)
    token = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    a, b = np.maximum(token_start[token], start[which]), np.minimum(token_end[token], end[which])
    some = a < b
    mask = np.zeros(len(token_end), bool)
    mask[token[some]] = True
    return mask, a[some], b[some]


def format_chats(rows: DataFrame, tokenizer: str = TOKENIZER, trained: frozenset[str] = frozenset({"assistant"}), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and a struct ``chat`` for each conversation: text, token_ids, token_ends, mask, and the masked pieces' bounds."""
    turns = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")))).alias("turns"))
    with open(tokenizer, encoding="utf-8") as f:
        data = turns.sparkSession.sparkContext.broadcast(f.read())  # a file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(data.value)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                chats = []
                for turns in part.column(1).to_pylist():
                    whole, start, end = render([(t["role"], t["text"]) for t in turns], trained)
                    code = tok.encode(whole, add_special_tokens=False)
                    ends = np.maximum.accumulate(np.array([b for _, b in code.offsets], np.int64)) if code.offsets else np.zeros(0, np.int64)
                    if len(ends):
                        ends[-1] = len(whole)
                    mask, a, b = align(ends, start, end)
                    chats.append({"text": whole, "token_ids": code.ids, "token_ends": ends, "mask": mask, "loss_start": a, "loss_end": b})
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(chats, kind)], names=["conv_id", "chat"])

    kind = pa.struct([("text", pa.string()), ("token_ids", pa.list_(pa.int32())), ("token_ends", pa.list_(pa.int64())), ("mask", pa.list_(pa.bool_())), ("loss_start", pa.list_(pa.int64())), ("loss_end", pa.list_(pa.int64()))])
    return turns.mapInArrow(run, T.StructType([turns.schema["conv_id"], T.StructField("chat", FIELDS)]))


_TOKENIZERS: dict[str, object] = {}


def _tokenizer(data: str):
    """One for each Python worker: a tokenizer takes long to build, and several would add up."""
    if data not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS.clear()
        tok = _TOKENIZERS[data] = Tokenizer.from_str(data)
        tok.no_truncation()
        tok.no_padding()
        tok.encode_special_tokens = True
    return _TOKENIZERS[data]


def masked_texts(text: str, start: list[int], end: list[int]) -> str:
    """Unescaped text of the masked pieces; pieces that touch are one, so that an escape cut by tokens is whole again."""
    out, a, b = [], None, None
    for x, y in zip(start, end, strict=True):
        if a is not None and x == b:
            b = y
            continue
        if a is not None:
            out.append(unescape(text[a:b]))
        a, b = x, y
    if a is not None:
        out.append(unescape(text[a:b]))
    return "".join(out)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, t, r, r"\### Assistant: </turn> ok") for t, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    chats = format_chats(rows.unionByName(own))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(len(batch)):
                conv, text, start, end = (column[i].as_py() for column in batch.columns)
                turns = parse(text)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = masked_texts(text, start, end)
                out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=shape)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    shape = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])
    return chats.select("conv_id", "chat.text", "chat.loss_start", "chat.loss_end").mapInArrow(digest, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(concat('### ', regexp_replace(role, '(\\|#|</turn>|:)', '\\\1', 'g'), ': ', regexp_replace(text, '(\\|#|</turn>)', '\\\1', 'g'), ' </turn>', chr(10)))) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""
