"""Token counts of whole texts by a byte-level BPE vocabulary.

Whole-token shortcut: most pre-tokens of a text are vocabulary strings that encode alone as
one token. Which ones do is proved once, on the driver, by splitting and merging every
vocabulary string; the proved set is bounded by the vocabulary. Inside the tasks a pre-token
of that set counts as one without any merge, and only the rest goes through the merges of the
library, remembered in a table of bounded size.

The pre-tokenizer's pattern, the byte alphabet and the special strings are read from the
tokenizer file's own kind: byte-level BPE without prefix space.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, ship

#: The split pattern of byte-level BPE with its default regex.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Merged pre-tokens that a task remembers before it starts afresh.
REMEMBERED = 400_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


@lru_cache(maxsize=4)
def load(path: str):
    """The library's tokenizer for a file, once per process."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Merger:
    """Counts tokens of one pre-token: 1 for proved strings, else by the library's merges."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.model = load(path).model
        self.letters = {b: c for b, c in enumerate(byte_alphabet())}
        self.whole = whole
        self.known: dict[str, int] = {}

    def alone(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)))

    def count(self, pieces: list[str]) -> int:
        whole, known = self.whole, self.known
        rest = [p for p in pieces if p not in whole]
        total = len(pieces) - len(rest)
        for p in rest:
            n = known.get(p)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[p] = self.alone(p)
            total += n
        return total


def special_strings(path: str) -> list[str]:
    """Strings that the library takes out of a text before it splits, longest first."""
    with open(path, encoding="utf-8") as f:
        return sorted((t["content"] for t in json.load(f)["added_tokens"]), key=len, reverse=True)


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token by themselves and merge into one token.

    A vocabulary entry that is no valid text, that the pattern splits, that is a special string
    or whose merges stop early is left out, so the shortcut never changes a count.
    """
    split, back = regex.compile(PATTERN), {c: b for b, c in enumerate(byte_alphabet())}
    special, merger, proved = set(special_strings(path)), Merger(path, frozenset()), []
    for entry in load(path).get_vocab():
        if entry in special or any(c not in back for c in entry):
            continue
        try:
            text = bytes(back[c] for c in entry).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if split.findall(text) == [text] and merger.alone(text) == 1:
            proved.append(text)
    return frozenset(proved)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated results, extra
    columns are ignored, an empty table gives an empty result. Whole texts are counted; a special
    string inside a text is one token, as the library has it by default.
    """
    ship(docs.sparkSession)
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, merger = regex.compile(PATTERN), Merger(path, whole.value)
        special = special_strings(path)
        cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            out = np.zeros(len(texts), np.int64)
            for i, value in enumerate(texts):
                text = value.as_py()
                if not text:
                    continue
                parts = cut.split(text) if cut else [text]
                out[i] = sum(merger.count(split.findall(p)) for p in parts) + len(parts) - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(out), pa.array(out > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    rows = docs.select(column(docs, id_col, "long").alias("doc_id"), column(docs, text_col, "string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean").select(
        "doc_id", "n_bytes", "n_tokens", F.coalesce("over_limit", F.lit(False)).alias("over_limit")
    )
