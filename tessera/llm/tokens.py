"""Token ids of documents by a public BPE vocabulary file, and their cutting into pieces.

Gives the ids of ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``, several
times faster: this vocabulary drops white space and splits words before merging, so a text may be
cut at blanks and new lines and each word's ids remembered.  A worker keeps one bounded memory of
words; a word that isn't in it is merged by the tokenizer itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
END_ID = 0
#: Words remembered by a worker; beyond that its memory starts anew.
REMEMBERED = 500_000
LONGEST_WORD = 64
#: The word pattern of the vocabulary file, for letters of Latin-1.
_WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\s\w]|_)+")
#: Latin-1 characters that Python and the tokenizer class differently.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Word -> its ids as little-endian uint16 bytes."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids don't fit into 16 bits")
        self.merge = self.tokenizer.model.tokenize
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def _merged(self, word: str) -> bytes:
        """Ids of one pre-token (already lower case)."""
        ids = [t.id for t in self.merge(word.encode().decode("latin-1").translate(self.letters))]
        return np.array(ids, "<u2").tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word:
            return b""
        if word.isalpha():
            ids = self._merged(word)
        elif word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        elif "<|" in word or _ODD.search(word):
            ids = self._whole(word)
        else:
            parts = _WORDS.findall(word)
            if len(parts) == 1 and parts[0] == word:
                ids = self._merged(word)
            else:
                return b"".join(map(self.__getitem__, parts))
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join([self._of_any(w) for w in words.split(" ")])
        return b"".join(map(self.__getitem__, words.lower().split(" ")))

    def _of_any(self, word: str) -> bytes:
        return self[word.lower()] if word.isascii() else self._whole(word)


_WORKER: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own tokenizer (loaded once)."""
    if path not in _WORKER:
        _WORKER[path] = WordIds(path)
    return _WORKER[path]


PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int, path: str, with_ids: bool = False, place: Callable[[list, list, list], np.ndarray] | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of at most ``size`` tokens; each document ends with END_ID.

    ``with_ids`` adds ``ids`` (binary, little-endian uint16); ``place`` a column of that name,
    reckoned from the doc_ids, piece numbers and ids_crc32 of a batch.  A null text is empty: one piece that
    holds END_ID only.
    """
    given = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    end = np.array([END_ID], "<u2").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        columns: list[list] = [[] for _ in kinds]

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            if place:
                arrays.append(pa.array(place(columns[0], columns[1], columns[4]), pa.int64()))
            made = pa.RecordBatch.from_arrays(arrays, names=[*names, "place"] if place else names)
            for c in columns:
                c.clear()
            return made

        held = 0
        for batch in batches:
            texts = batch.column("text")
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids = words.encode(texts[k].as_py()) + end
                for at in range(0, len(ids), 2 * size):
                    part = ids[at:at + 2 * size]
                    crc = zlib.crc32(np.frombuffer(part, "<u2").astype("<u4").tobytes())
                    row = (doc, at // (2 * size), at // 2, len(part) // 2, crc, part)
                    for c, v in zip(columns, row, strict=False):
                        c.append(v)
                    held += 64 + len(part) * with_ids
                if held > 8_000_000:
                    yield batch_of()
                    held = 0
        yield batch_of()

    return given.mapInArrow(cut, PIECES_DDL + ", ids binary" * with_ids + ", place long" * bool(place))
