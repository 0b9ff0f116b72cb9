"""Token counts by dynamic programming over prefixes, for sentencepiece BPE models with byte fallback.

A sequence of pieces is the encoding of its text exactly if each neighbouring pair of pieces is the encoding of the two
pieces' text: until a merge crosses the border of a pair, the merges on each side run as they would alone. So the last
piece of every prefix follows from the last pieces of shorter prefixes, and

    count[i] = count[i - len(piece)] + 1,  the piece being the one that fits last[i - len(piece)].

This gives the exact token count at every prefix, so that truncation and budget questions are answered from the table
and nothing is encoded again. No piece of such a model has white space behind another character, and a character that
is in no longer piece never merges; at both the text falls into independent parts, and the tables of parts are kept."""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
LIMIT = 4096
MODEL = "piece_bpe_32k.model"
#: Tables of parts, and tested pairs, kept by a worker; beyond that it starts anew, which changes no count.
CACHE_PARTS = 1_000_000
CACHE_PAIRS = 1_000_000
#: Longer parts are counted like others, but their tables aren't kept.
KEPT_CHARS = 64


class PrefixCounter:
    """Exact prefix token counts under one model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores = {
            sp.id_to_piece(i): sp.get_score(i)
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        }
        if any(SPACE in p.lstrip(SPACE) for p in self.scores) or sp.encode("a  b", out_type=str) == sp.encode("a b", out_type=str):
            raise ValueError("the model merges across or removes white space; its parts aren't independent")
        inner = {c for p in self.scores if len(p) > 1 for c in p}
        self._lone = re.compile("([^" + "".join(map(re.escape, sorted(inner))) + "])")
        if not all(c in self.scores for c in inner):
            raise ValueError("a character of a piece is no piece itself")
        #: Pieces that encode as themselves, with their numbers, in one automaton that finds all of them in a part.
        self.pieces = [p for p in self.scores if len(p) == 1 or self.merge(p) == [p]]
        self._finder = ahocorasick.Automaton()
        for i, p in enumerate(self.pieces, 1):
            self._finder.add_word(p, (len(p), i))
        self._finder.make_automaton()
        self._fits: dict[int, bool] = {}
        self._parts: dict[str, bytes | tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The encoding as the model defines it: again and again merge the neighbours that make the best piece."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def part(self, text: str) -> bytes | tuple[int, ...]:
        """Token counts at the prefixes 1..n of an independent part."""
        found = self._parts.get(text)
        if found is not None:
            return found
        if len(text) == 1 and text not in self.scores:
            return (len(text.encode()),)  # a character that is no piece becomes its bytes
        fits, top = self._fits, len(self.pieces) + 1
        last, count = [0] * (len(text) + 1), [0] * (len(text) + 1)  # the number of each prefix's last piece; 0 at the start
        for end, (size, new) in self._finder.iter(text):
            end += 1
            if last[end]:
                continue
            before = last[end - size]
            if before:
                key = before * top + new
                ok = fits.get(key)
                if ok is None:
                    pair = [self.pieces[before - 1], self.pieces[new - 1]]
                    ok = fits[key] = self.merge(pair[0] + pair[1]) == pair
                if not ok:
                    continue
            elif end != size:
                continue
            last[end] = new
            count[end] = count[end - size] + 1
        if 0 in last[1:]:
            raise AssertionError(f"no piece ends at {last.index(0, 1)} of {text!r}")
        if len(fits) >= CACHE_PAIRS:
            fits.clear()
        out = bytes(count[1:]) if count[-1] < 256 else tuple(count[1:])
        if len(text) <= KEPT_CHARS:
            if len(self._parts) >= CACHE_PARTS:
                self._parts.clear()
            self._parts[text] = out
        return out

    def parts(self, text: str) -> list[str]:
        """The independent parts of a text behind the model's leading space; together they are that string."""
        if not text:
            return []
        out: list[str] = []
        for line in self._lone.split(SPACE + text.replace(" ", SPACE)):
            if not line:
                continue
            words = line.split(SPACE)
            if "" in words[1:]:
                out += re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", line)
                continue
            if words[0]:
                out.append(words[0])
            out += [SPACE + w for w in words[1:]]
        return out

    def total(self, text: str) -> int:
        """Tokens of the whole text: the last entry of its table."""
        part, known = self.part, self._parts
        return sum((known.get(p) or part(p))[-1] for p in self.parts(text))

    def table(self, text: str) -> np.ndarray:
        """Token count at every prefix 0..len(text), in characters."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        out, base = [], 0
        for p in self.parts(text):
            counts = self.part(p)
            out += [base + c for c in counts]
            base += counts[-1]
        return np.array([0, *out[1:]], dtype=np.int64)  # the leading space alone belongs to no prefix

    def fit(self, text: str, budget: int) -> int:
        """The longest prefix, in characters, from which no prefix on the way has more than ``budget`` tokens."""
        most = np.maximum.accumulate(self.table(text))
        return bisect_right(most, budget) - 1


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as an empty one, with no tokens. A null doc_id stays null; repeated rows get a row each; other
    columns of ``docs`` are ignored; an empty table gives an empty result. ``path`` must be readable on executors."""
    path = path or default_path()

    def run(batches):
        c = counter(path)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            n = np.array([c.total(x) if x else 0 for x in texts], dtype=np.int64)
            size = [len(x.encode()) if x else 0 for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text")).mapInArrow(run, OUT)


def truncate_to_budget(docs: DataFrame, budget: int, path: str | None = None) -> DataFrame:
    """doc_id, text cut to the longest prefix within ``budget`` tokens, its n_tokens, and truncated; nulls as empty."""
    path = path or default_path()

    def run(batches):
        c = counter(path)
        for batch in batches:
            texts = [x or "" for x in batch.column("_text").to_pylist()]
            tables = [c.table(x) for x in texts]
            ends = [bisect_right(np.maximum.accumulate(t), budget) - 1 for t in tables]
            arrays = [batch.column("doc_id"), pa.array([x[:e] for x, e in zip(texts, ends)], pa.string()), pa.array([int(t[e]) for t, e in zip(tables, ends)], pa.int64()), pa.array([e < len(x) for x, e in zip(texts, ends)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_tokens", "truncated"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text")).mapInArrow(run, "doc_id long, text string, n_tokens long, truncated boolean")
