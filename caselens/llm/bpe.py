"""BPE with word ends: greedy proposals, vectorised checks of neighbours, exact merging of the rest."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from caselens.llm.common import in_arrow, text_or_empty
from caselens.llm.tokens import PLAIN, byte_alphabet, token_bytes

# Distinct words whose ids a worker remembers before it starts anew, and characters of text that
# are encoded at once.
REMEMBERED, TOGETHER = 300_000, 1 << 21
# Fixed value: what the vocabulary's library takes as one word; all else is dropped.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
_NEVER = 1 << 40


class WordBpe:
    """Encodes single words. ``left`` and ``right`` tell which two tokens a token was merged from.

    Ids of merged tokens rise in the order of the merges (the file is checked for that), so an id
    tells when its merge happens.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        parts = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocabulary[a + b] for a, b in parts]
        self.size, self.base = len(vocabulary), len(vocabulary) - len(made)
        if made != list(range(self.base, self.size)):
            raise ValueError(f"{path}: merges are not in the order of their ids")
        self.names = sorted(vocabulary, key=vocabulary.get)
        self.left, self.right = (
            np.r_[np.arange(self.base), [vocabulary[p[k]] for p in parts]] for k in (0, 1)
        )
        keys = self.left[self.base :] * self.size + self.right[self.base :]
        order = np.argsort(keys)
        self.keys, self.made = keys[order], np.arange(self.base, self.size)[order]
        self.merged = dict(zip(keys.tolist(), range(self.base, self.size)))
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}

        # Tokens that merging really leaves whole; only these are proposed. A token counts as whole
        # if no other merge across its halves comes before its own, and its halves are whole.
        whole = np.ones(self.size, bool)
        whole[self.base :] = self.compatible(
            self.left[self.base :], self.right[self.base :], np.arange(self.base, self.size)
        )
        for token in range(self.base, self.size):
            whole[token] &= whole[self.left[token]] and whole[self.right[token]]
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token in np.flatnonzero(whole).tolist():
            name = self.names[token]
            if name.endswith(END):
                self.final[token_bytes(name[: -len(END)])] = token
            else:
                self.inner[token_bytes(name)] = token
        self.longest = max(map(len, self.inner))
        self.longest_final = max(map(len, self.final))

    def compatible(
        self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None
    ) -> np.ndarray:
        """For each pair of tokens, whether merging their text leaves just these two.

        Time runs backwards: of the two tokens that meet, the one merged last is split again, and
        what then meets must not have a merge of its own that comes earlier. Of equal merges the
        left one is first. ``until`` looks only at merges before the given ones.
        """
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), _NEVER) if until is None else until.copy()
        good, open_ = np.ones(len(left), bool), np.arange(len(left))
        while len(open_):
            a, b = left[open_], right[open_]
            keys = a * self.size + b
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            merges = np.where(self.keys[at] == keys, self.made[at], _NEVER)
            crossed = merges < limit[open_]
            good[open_[crossed]] = False
            split_left = a > b
            last = np.maximum(a, b)
            going = ~crossed & (last >= self.base)
            open_, a, b, split_left = open_[going], a[going], b[going], split_left[going]
            limit[open_] = np.where(split_left, a, b + 1)
            left[open_] = np.where(split_left, self.right[a], a)
            right[open_] = np.where(split_left, b, self.left[b])
        return good

    def proposed(self, word: bytes) -> list[int]:
        """Greedy: the longest token each time; the last one must end the word."""
        out, start, size = [], 0, len(word)
        final, inner, longest = self.final, self.inner, self.longest
        ending = size - self.longest_final
        while True:
            token = final.get(word[start:]) if start >= ending else None
            if token is not None:
                out.append(token)
                return out
            stop = min(size - 1, start + longest)
            while (token := inner.get(word[start:stop])) is None:
                stop -= 1
            out.append(token)
            start = stop

    def exact(self, word: bytes) -> list[int]:
        """Merging by definition: always the earliest merge, of equal ones the leftmost.

        A heap of candidate merges over a linked list; n log n steps for n bytes.
        """
        tokens = [self.inner[word[i : i + 1]] for i in range(len(word) - 1)]
        tokens.append(self.final[word[-1:]])
        size, merged, count = self.size, self.merged, len(tokens)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = [
            (token, i)
            for i in range(count - 1)
            if (token := merged.get(tokens[i] * size + tokens[i + 1])) is not None
        ]
        heapq.heapify(heap)
        while heap:
            token, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= count or merged.get(tokens[i] * size + tokens[j]) != token:
                continue
            tokens[i], tokens[j] = token, -1
            after[i] = k = after[j]
            if k < count:
                before[k] = i
                if (new := merged.get(token * size + tokens[k])) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0:
                if (new := merged.get(tokens[h] * size + token)) is not None:
                    heapq.heappush(heap, (new, h))
        return [t for t in tokens if t >= 0]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: proposals, all their neighbours checked at once, failures merged."""
        found = [self.proposed(word) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), np.int64, int(sizes.sum()))
        word_of = np.repeat(np.arange(len(found)), sizes)
        meet = word_of[1:] == word_of[:-1]
        good = self.compatible(flat[:-1][meet], flat[1:][meet])
        for word in np.unique(word_of[1:][meet][~good]).tolist():
            found[word] = self.exact(words[word])
        return found


class TextBpe:
    """Whole texts, with the words met before kept by their ids and decoded form."""

    def __init__(self, path: str):
        self.words = WordBpe(path)
        self.library = Tokenizer.from_file(path)
        special = "|".join(map(regex.escape, self.words.special)) or r"(?!)"
        self.special = regex.compile(f"({special})")
        self.alphabet = byte_alphabet()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.decoded: list[str] = []

    def split(self, text: str) -> list[str]:
        """Normalised words in order. Plain texts need only lower case; the library does the rest."""
        if "<|" not in text:
            return self._split(text)
        out: list[str] = []
        for part in self.special.split(text):
            out += [part] if part in self.words.special else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return WORD.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [token_bytes(word).decode() for word, _ in found]

    def _learn(self) -> None:
        new = list(islice(self.known, len(self.decoded), None))
        if not new:
            return
        special = self.words.special
        found = self.words.encode([word.encode() for word in new if word not in special])
        if len(found) < len(new):
            rest = iter(found)
            found = [[special[word]] if word in special else next(rest) for word in new]
        names = dict(zip(special.values(), special))
        for word, ids in zip(new, found):
            self.decoded.append(
                word if word in special
                else " ".join([names[i] if i in names else self.words.names[i] for i in ids])
            )
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), "<u4", int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids and decoded text of each text."""
        if len(self.decoded) > REMEMBERED:
            self._forget()
        known = self.known
        rows = [[known.setdefault(w, len(known)) for w in self.split(text)] for text in texts]
        self._learn()
        for row in rows:
            at = np.array(row, np.int64)
            starts, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
            total = int(sizes.sum())
            shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
            yield self.ids[np.arange(total) + shift], " ".join([self.decoded[i] for i in row])


@lru_cache(maxsize=2)
def text_bpe(path: str) -> TextBpe:
    """One encoder per Python worker."""
    return TextBpe(path)


def _round_trips(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = text_bpe(path)
    for batch in batches:
        texts, start = batch.column("text").to_pylist(), 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= TOGETHER):
                size += len(texts[stop])
                stop += 1
            found = list(encoder.encode(texts[start:stop]))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").slice(start, stop - start),
                    "n_tokens": pa.array([len(ids) for ids, _ in found], pa.int64()),
                    "ids": pa.array([ids.tobytes() for ids, _ in found], pa.binary()),
                    "decoded": pa.array([text for _, text in found], pa.string()),
                }
            )
            start = stop


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` for each row of ``docs (doc_id, text, ...)``.

    ``ids`` holds little-endian 32-bit numbers, without added begin or end; ``decoded`` is the text
    that these ids give. Special strings inside a text are their special token. A NULL text counts
    as empty: no ids, empty decoded text. Repeated rows stay repeated, a NULL doc_id stays NULL,
    other columns are not looked at, no rows give none.
    """
    narrow = docs.select("doc_id", text_or_empty().alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.transform(
        in_arrow,
        partial(_round_trips, path),
        f"doc_id {kind}, n_tokens long, ids binary, decoded string",
    )
