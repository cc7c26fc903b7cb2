"""Token counts: a linear longest-match automaton over a word-piece vocabulary.

The vocabulary's pieces form a trie over bytes. Where a state has no edge for the next byte, its failure link leads on: the
link's pieces are those that greedy longest match takes from the state's text, and their number was worked out with the link.
So every byte is read once, no piece is built, and a word's count is the sum of the links' numbers on its way and at its end.

A word is a run of characters other than ASCII white space, matched as the word mark followed by the word's UTF-8 bytes. Every
single byte is a piece, too (byte fallback), so that each text has a count: bytes that no piece covers count one each.

Words of a batch run side by side, a numpy step for each byte position; words over ``LONG`` bytes run alone. Counts of words
seen are kept in a table of bounded size.

Cases: null or empty text, white space only: 0 tokens and 0 words. Very long words: linear time. Repeated rows: each is
counted. An empty vocabulary counts bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaspark.llm.common import table, with_columns_from_text

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("n_words", T.LongType())]
LONG = 64
KEPT_WORDS = 200_000


def read_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model; byte, control and unknown pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]


class Automaton:
    def __init__(self, pieces: list[str]):
        wanted = {p.encode() for p in pieces if p} | {bytes([b]) for b in range(256)}
        child: list[dict[int, int]] = [{}]
        parent, label, is_piece = [0], [0], [False]
        for piece in sorted(wanted):
            node = 0
            for b in piece:
                nxt = child[node].get(b)
                if nxt is None:
                    nxt = child[node][b] = len(child)
                    child.append({})
                    parent.append(node)
                    label.append(b)
                    is_piece.append(False)
                node = nxt
            is_piece[node] = True
        n = len(child)
        fail, popped, tail = [0] * n, [0] * n, [0] * n
        level = [0]
        while level:
            below = []
            for node in level:
                for b, v in child[node].items():
                    if is_piece[v]:
                        fail[v], popped[v] = 0, 1
                    else:  # what the parent's text gives up, until the byte can follow
                        z, count = fail[node], popped[node]
                        while b not in child[z]:
                            count += popped[z]
                            z = fail[z]
                        fail[v], popped[v] = child[z][b], count
                    tail[v] = popped[v] + tail[fail[v]]
                    below.append(v)
            level = below
        self._child = child
        self._fail, self._popped, self._tail = np.array(fail, np.int32), np.array(popped, np.int64), np.array(tail, np.int64)
        keys = sorted((node * 256 + b, v) for node, edges in enumerate(child) for b, v in edges.items())
        self._keys, self._to = np.array([k for k, _ in keys], np.int64), np.array([v for _, v in keys], np.int32)

    def count_one(self, word: bytes) -> int:
        child, fail, popped = self._child, self._fail, self._popped
        state = total = 0
        for b in word:
            while b not in child[state]:
                total += int(popped[state])
                state = int(fail[state])
            state = child[state][b]
        return total + int(self._tail[state])

    def count(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        out = np.zeros(len(words), np.int64)
        size = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(size > LONG):
            out[i] = self.count_one(words[i])
        live = np.flatnonzero(size <= LONG)
        live = live[np.argsort(-size[live], kind="stable")]
        size = size[live]
        text = np.frombuffer(b"".join(words[i] for i in live), np.uint8)
        start = np.r_[0, np.cumsum(size)[:-1]] if len(size) else size
        state, total = np.zeros(len(live), np.int32), np.zeros(len(live), np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            m = np.searchsorted(-size, -step, side="left")  # words longer than step come first
            byte = text[start[:m] + step].astype(np.int64)
            todo = np.arange(m)
            while len(todo):
                key = state[todo].astype(np.int64) * 256 + byte[todo]
                at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
                found = self._keys[at] == key
                state[todo[found]] = self._to[at[found]]
                todo = todo[~found]
                total[todo] += self._popped[state[todo]]
                state[todo] = self._fail[state[todo]]
        out[live] = total + self._tail[state]
        return out


class Counter:
    """Counts of texts; each Python worker builds its automaton once."""

    def __init__(self, pieces: list[str]):
        self._pieces = pieces
        self._automaton: Automaton | None = None
        self._kept: dict[bytes, int] = {}

    def __getstate__(self):
        return {"_pieces": self._pieces, "_automaton": None, "_kept": {}}

    def count(self, texts: list[str | None]) -> list[list[int]]:
        if self._automaton is None:
            self._automaton = Automaton(self._pieces)
        words = [(t or "").encode("utf-8", "replace").split() for t in texts]
        tokens = [0] * len(words)
        for a in range(0, len(words), 64):
            self._learn(words[a : a + 64])
            for i in range(a, min(a + 64, len(words))):
                tokens[i] = sum(map(self._kept.__getitem__, words[i]))
        return [tokens, [len(w) for w in words]]

    def _learn(self, words: list[list[bytes]]) -> None:
        if len(self._kept) > KEPT_WORDS:
            self._kept.clear()
        new = list(set().union(*words) - self._kept.keys())
        mark = MARK.encode()
        self._kept.update(zip(new, self._automaton.count([mark + w for w in new]).tolist(), strict=True))


def count_tokens(docs: DataFrame, pieces: list[str], text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and n_words."""
    held = docs.sparkSession.sparkContext.broadcast(Counter(pieces))  # size of the vocabulary
    return with_columns_from_text(docs, text, FIELDS, lambda texts: held.value.count(texts))


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), read_pieces(vocabulary)).select("doc_id", F.col("n_tokens"), "n_words")

