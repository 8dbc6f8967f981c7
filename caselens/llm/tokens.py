"""Token counts and ids of a byte-level BPE vocabulary."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caselens.llm.common import in_arrow, per_batch, text_or_empty

LIMIT = 512
# Characters of one piece of a long text, and of the pieces that are encoded together.
PIECE, TOGETHER = 1 << 15, 1 << 20
# Fixed value: how the vocabulary's library cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Texts of these characters are cut alike by every version of the character tables.
PLAIN = re.compile("[\t-\r\x20-\x7e\xa1-ɏ]*")
# The fast encoder's pattern gives up on white space of about a million characters; such texts are
# left to the library.
_LONG_GAP = re.compile(r"\s{10000}")
# A token never spans white space that follows a letter or digit, so a text may be cut there.
_CUT = re.compile(r"(?<=[0-9A-Za-z])[ \n]")


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: printable Latin-1 characters
    stand for themselves, the other bytes in order for those from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(token: str) -> bytes:
    alphabet = byte_alphabet()
    return bytes(alphabet[c] for c in token)


class ByteBpe:
    """Ids as the file's own library gives them, without added begin or end.

    Texts of plain characters go through an encoder of the same ranks that is three times as fast,
    all others through the library itself. The fast encoder merges by id, which is right when the
    merges are listed in the order of the ids they make; the file is checked for that.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocabulary[a + b] for a, b in pairs]
        if made != sorted(made) or len(vocabulary) != len(made) + 256:
            raise ValueError(f"{path}: merges are not in the order of their ids")
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        ranks = {token_bytes(token): number for token, number in vocabulary.items()}
        self.fast = tiktoken.Encoding(
            "bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def plain(self, text: str) -> bool:
        """Whether the fast encoder may read a text."""
        return bool(
            PLAIN.fullmatch(text)
            and not self.special.search(text)
            and (len(text) < 10_000 or not _LONG_GAP.search(text))
        )

    def batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; special strings inside a text become their special token."""
        if all(map(self.plain, texts)):
            return [self.fast.encode_ordinary(t) for t in texts]
        found = self.library.encode_batch(texts, add_special_tokens=False)
        return [f.ids for f in found]

    def ids(self, text: str) -> np.ndarray:
        parts = [np.array(self.batch([p])[0], "<u4") for p in pieces(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per Python worker."""
    return ByteBpe(path)


def pieces(text: str, size: int = PIECE) -> list[str]:
    """The text in pieces of about ``size`` characters whose tokens are those of the text in order.

    A piece ends where white space follows a letter or digit; without such a place it goes on.
    """
    out, start = [], 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


def _lengths(path: str, batch: pa.RecordBatch) -> pa.RecordBatch:
    encoder, texts = byte_bpe(path), batch.column("text").to_pylist()
    counts = np.zeros(len(texts), np.int64)
    held: list[tuple[int, str]] = []
    size = 0
    for row, text in enumerate(texts):
        for piece in pieces(text):
            held.append((row, piece))
            size += len(piece)
            if size >= TOGETHER:
                _add(encoder, held, counts)
                held, size = [], 0
    _add(encoder, held, counts)
    return pa.record_batch(
        {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
         "n_tokens": pa.array(counts)}
    )


def _add(encoder: ByteBpe, held: list[tuple[int, str]], counts: np.ndarray) -> None:
    """Encode the held pieces in two batches, plain and other, and add up lengths by row."""
    plain = [encoder.plain(p) for _, p in held]
    for kind in (True, False):
        some = [x for x, k in zip(held, plain) if k == kind]
        if some:
            lengths = list(map(len, encoder.batch([p for _, p in some])))
            np.add.at(counts, [row for row, _ in some], lengths)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for each row of ``docs (doc_id, text, ...)``.

    Only lengths leave the encoder. Pieces of about equal size are encoded together, whatever the
    lengths of their texts. A NULL text counts as empty; empty texts have no tokens. Repeated rows
    stay repeated, a NULL doc_id stays NULL, other columns are not looked at, no rows give none.
    """
    narrow = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes")
    )
    kind = narrow.schema["doc_id"].dataType.simpleString()
    counted = narrow.transform(
        in_arrow, per_batch(partial(_lengths, path)),
        f"doc_id {kind}, n_bytes long, n_tokens long",
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def id_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(doc_id, ids)`` of each row, in order."""
    encoder = byte_bpe(path)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            yield doc_id.as_py(), encoder.ids(text.as_py())
