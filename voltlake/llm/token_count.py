"""Token counts with a shortcut for words that are one token.

Which vocabulary strings encode alone as one token is proved once, by encoding each of them
with the library. A text is split into pre-tokens as the tokenizer splits it; those on the
proven list count one each, and only the others are merged, each distinct one once a batch.

The splitting is done here only for texts whose characters leave no doubt: code points below
U+0300 without rare controls, for which lower-casing, composition and white space agree
with the library, and without the special tokens' strings. All other texts are encoded whole by
the library, and so are all texts for a vocabulary file that splits or normalises in another way than
this module, so every count is the library's.

Defined cases: a null text counts as empty and has no tokens; a null id stays null; the texts
are never cut; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of the vocabulary file, in its own pattern (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What the vocabulary file must say of itself for texts to be split here (fixed values).
SPLIT_HERE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": PRE_TOKEN}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Characters for which the split here isn't proven to be the library's.
DOUBTFUL = r"[^\x09\x0A\x0D\x20-\x7E\xA0-\u02FF]"
#: Encodings of merged pre-tokens that a worker remembers.
REMEMBERED = 1 << 19
#: Texts counted together.
SLICE = 256


class Counter49k:
    """Counts tokens of batches of texts; one per Python worker and vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = regex.compile(
            "|".join(regex.escape(t["content"]) for t in described["added_tokens"]) or r"(?!)"
        )
        self.doubtful = regex.compile(DOUBTFUL)
        self.pre_token = regex.compile(PRE_TOKEN)
        self.split_here = all(described[k] == v for k, v in SPLIT_HERE.items())
        self.single = self.prove_single(described["model"]) if self.split_here else frozenset()
        self.merged: dict[str, int] = {}

    def sizes(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def prove_single(self, model: dict) -> frozenset[str]:
        """Strings that the library encodes alone as one token and that are one pre-token."""
        mapped = {c: b for b, c in byte_characters().items()}
        end = model["end_of_word_suffix"]
        strings = []
        for entry in model["vocab"]:
            word = entry.removesuffix(end)
            if entry.endswith(end) and all(c in mapped for c in word):
                try:
                    strings.append(bytes(mapped[c] for c in word).decode())
                except UnicodeDecodeError:  # part of a character, never a pre-token
                    continue
        plain = [s for s in strings if not self.doubtful.search(s) and s.lower() == s]
        whole = [s for s in plain if self.pre_token.findall(s) == [s]]
        return frozenset(s for s, n in zip(whole, self.sizes(whole), strict=True) if n == 1)

    def count(self, texts: list[str]) -> list[int]:
        out, plain, whole = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            (whole if not self.split_here or self.doubtful.search(text) or self.special.search(text) else plain).append(i)
        for i, n in zip(whole, self.sizes([texts[i] for i in whole]), strict=True):
            out[i] = n
        rest: dict[int, Counter] = {}
        unknown: set[str] = set()
        for i in plain:
            found = self.pre_token.findall(texts[i].lower())
            others = Counter(t for t in found if t not in self.single)
            out[i] = len(found) - others.total()
            rest[i] = others
            unknown.update(t for t in others if t not in self.merged)
        fresh = list(unknown)
        sizes = dict(zip(fresh, self.sizes(fresh), strict=True))
        for i, others in rest.items():
            out[i] += sum(
                n * (sizes[t] if t in sizes else self.merged[t]) for t, n in others.items()
            )
        if len(self.merged) + len(sizes) > REMEMBERED:
            self.merged = {}
        self.merged |= sizes
        return out


def byte_characters() -> dict[int, str]:
    """The characters byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}


@functools.lru_cache(maxsize=2)
def counter_of(path: str) -> Counter49k:
    return Counter49k(path)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    *,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every whole text.

    ``vocabulary`` is the path of the tokenizer file on every executor.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            sizes: list[int] = []
            for at in range(0, batch.num_rows, SLICE):  # few texts' words are held at a time
                sizes += counter.count(batch["text"].slice(at, SLICE).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["n_bytes"], pa.array(sizes, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    text = F.coalesce(text_col, F.lit(""))
    return (
        docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
        .mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
