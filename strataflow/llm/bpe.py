"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import whole, without

#: Words whose ids a worker remembers, at least half of them: some 200 bytes each.
REMEMBERED = 400_000
#: Characters that are cut up at a time, about.
GROUP_CHARACTERS = 500_000
#: Text or ids that a batch passes on at a time, about.
PART_BYTES = 4_000_000
# Fixed value: the code points with the Unicode property White_Space, which is the \s of
# the pattern that splits text before merging.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_SPACE}]", c))
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = r"!-/:-@\[-`{-~"
# A run of letters ends a match of the split pattern where a mark follows.
_PIECE = re.compile(f"[{_SPACE}]*[{_LATIN}]+(?=[{_MARKS}])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
# Marks that often end a word, and the last letter of the blocks of Latin letters.
_ENDS, _LAST_LATIN = (".", ",", ";", ":", "!", "?"), "\u024f"
_BLANK_AFTER_SPACE = [c + " " for c in sorted(_SPACES)]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Bytes that print in Latin-1 stand for themselves, the others for the code points from
    256 on, in order.
    """
    prints = [chr(b).isprintable() and chr(b) != " " for b in range(256)]
    moved = iter(range(256, 512))
    return [chr(b) if prints[b] else chr(next(moved)) for b in range(256)]


# Bytes, as Latin-1, to their characters; a line feed parts words and stays.
_SHOWN = {b: c for b, c in enumerate(byte_characters()) if b != ord("\n")}


def _is_latin(word: str) -> bool:
    return word.isalpha() and (word.isascii() or max(word) <= _LAST_LATIN)


def _tokenizer_of_ranks(path: str, pattern: str):
    """A tokenizer that merges as the rank file says: the pair with the lowest rank first.

    A rank file names tokens, not pairs, so every split of a token into two tokens is a
    merge of its rank.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    shown = byte_characters()
    vocabulary = {"".join(shown[b] for b in token): rank for token, rank in ranks.items()}
    merges = [
        (token[:k], token[k:])
        for token in sorted(vocabulary, key=vocabulary.__getitem__)
        for k in range(1, len(token))
        if token[:k] in vocabulary and token[k:] in vocabulary
    ]
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def load_tokenizer(path: str, pattern: str | None = None):
    """The tokenizer of a ``.json`` file, or of a ``.tiktoken`` rank file and its pattern."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path.endswith(".tiktoken"):
        if pattern is None:
            raise ValueError("a rank file needs the pattern that splits text")
        return _tokenizer_of_ranks(path, pattern)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # in a text they are ordinary text
    return tokenizer


def _trimmed(known: dict[str, bytes], most: int) -> dict[str, bytes]:
    """All of a small table, else its older half: frequent words come up early."""
    return known if len(known) <= most else dict(islice(known.items(), most // 2))


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes that each id stands for: the byte table of a vocabulary, reversed."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines]
        known = {int(rank): base64.b64decode(token) for token, rank in pairs}
    else:
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        of_character = {c: b for b, c in enumerate(byte_characters())}
        known = {
            number: bytes(of_character[c] for c in token)
            if all(c in of_character for c in token)
            else token.encode()  # no byte-level token: it stands for its own text
            for token, number in vocabulary.items()
        }
    table = [b""] * (max(known, default=-1) + 1)
    for number, token in known.items():
        table[number] = token
    return table


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    """The bytes that the ids stand for; an unknown id raises."""
    return b"".join([table[i] for i in ids.tolist()])


class Codec:
    """Encodes texts to ids, in one worker."""

    _loaded: dict[tuple, Codec] = {}

    def __init__(self, path: str, pattern: str | None = None, remember: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.remember = remember
        self.tokenizer = load_tokenizer(path, pattern)
        # The same merges for text that is cut up and mapped to characters already.
        self._bare = Tokenizer(self.tokenizer.model)
        self._bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._ends = dict(zip(_ENDS, self._encode_apart(list(_ENDS)), strict=True))
        self.widths = np.array([len(b) for b in token_bytes(path)], np.int64)

    @classmethod
    def of(cls, path: str, pattern: str | None = None, remember: int = REMEMBERED) -> Codec:
        """The worker's codec, loaded once."""
        key = (path, pattern, remember)
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def _encode_together(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of parts that start with white space and end without, encoded as one text.

        No match of the split pattern crosses from one to the next, so the ids are cut
        apart again by the bytes that they stand for.
        """
        if not parts:
            return
        text = self.tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0]
        yield from self._cut(np.array(text.ids, "<u4"), parts)

    def _cut(self, ids: np.ndarray, parts: list[str]) -> Iterator[bytes]:
        """The ids of each part, from those of all of them in order."""
        if not parts:
            return
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in parts])
        cuts = np.searchsorted(np.cumsum(self.widths[ids]), ends, side="left") + 1
        blob, start = ids.tobytes(), 0
        for cut in (4 * cuts).tolist():
            yield blob[start:cut]
            start = cut

    def _encode_matches(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words of Latin letters, each with a blank before it.

        Each is one match of the split pattern. Their bytes are mapped to characters here,
        so the library only has to part them at line feeds and merge.
        """
        shown = "\n".join(words).encode().decode("latin-1").translate(_SHOWN)
        blank = _SHOWN[ord(" ")]
        text = blank + shown.replace("\n", "\n" + blank) if words else ""
        found = self._bare.encode_batch_fast([text], add_special_tokens=False)[0]
        yield from self._cut(np.array(found.ids, "<u4"), [" " + w for w in words])

    def _encode_apart(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def _by_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts from those of their pieces, see ``_PIECE``.

        A text is cut before white space that follows another character, and between a
        letter and a mark. No match of the split pattern crosses such a place and none
        looks past it, so the ids of a text are those of its pieces in order.
        """
        cut = [_PIECE.findall(t) for t in texts]
        self._pieces = _trimmed(self._pieces, self.remember)
        new: set[str] = set()
        for pieces in cut:
            new.update(pieces)
        new = new.difference(self._pieces)  # looks up the new ones, not all that are known
        together = [p for p in new if p[0] in _SPACES and p[-1] not in _SPACES]
        apart = list(new.difference(together))
        self._pieces.update(zip(together, self._encode_together(together), strict=True))
        self._pieces.update(zip(apart, self._encode_apart(apart), strict=True))
        known = self._pieces.__getitem__
        return [b"".join(map(known, pieces)) for pieces in cut]

    def _learn_words(self, new: set[str]) -> None:
        """Remember the ids of new words, each with a blank before it."""
        words = self._words
        plain, marked, other = [], [], []
        for word in new:
            if _is_latin(word):
                plain.append(word)
            elif word[-1:] in _ENDS and _is_latin(word[:-1]):
                marked.append(word)
            else:
                other.append(word)
        stems = {w[:-1] for w in marked}.difference(words, plain)
        plain.extend(stems)
        words.update(zip(plain, self._encode_matches(plain), strict=True))
        ends = self._ends
        for word in marked:
            words[word] = words[word[:-1]] + ends[word[-1]]
        words.update(zip(other, self._by_pieces([" " + w for w in other]), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.

        Most texts have single blanks between words: they are cut there at once, and the
        ids of a blank and a word are looked up.
        """
        results: list[np.ndarray] = []
        for at, stop in self._groups(texts):
            self._words = _trimmed(self._words, self.remember)
            group: list[tuple[list[str], list[bytes | None], list[int]]] = []
            heads: list[str] = []
            new: set[str] = set()
            known = self._words.get
            for text in texts[at:stop]:
                if any(pair in text for pair in _BLANK_AFTER_SPACE):
                    heads.append(text)
                    group.append(([], [], []))
                    continue
                head, *rest = text.split(" ")
                heads.append(head)
                found = list(map(known, rest))
                lacking = [k for k, ids in enumerate(found) if ids is None] if None in found else []
                new.update(rest[k] for k in lacking)
                group.append((rest, found, lacking))
            self._learn_words(new)
            for head, (rest, found, lacking) in zip(self._by_pieces(heads), group, strict=True):
                for k in lacking:
                    found[k] = self._words[rest[k]]
                results.append(np.frombuffer(b"".join([head, *found]), "<u4"))
        return results

    @staticmethod
    def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
        """Ranges of texts of about ``GROUP_CHARACTERS`` together."""
        start = letters = 0
        for k, text in enumerate(texts):
            letters += len(text)
            if letters >= GROUP_CHARACTERS:
                yield start, k + 1
                start, letters = k + 1, 0
        if start < len(texts):
            yield start, len(texts)

    def starts(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Code point at which each token starts; tokens that split a character share it."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.widths[ids.astype(np.int64)])
        return character[ends - self.widths[ids.astype(np.int64)]]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))


def text_sizes(batch: pa.RecordBatch) -> pa.Array:
    return pc.binary_length(batch.column("text"))


def over_batches(
    add: Callable[[pa.RecordBatch], dict[str, pa.Array]], sizes: Callable[[pa.RecordBatch], pa.Array]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Add columns to batches, cut into parts of about ``PART_BYTES`` so that few are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = sizes(batch).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(long) // PART_BYTES
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                some = batch.slice(start, end - start)
                columns = dict(zip(some.schema.names, some.columns, strict=True)) | add(some)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def encode(
    docs: DataFrame,
    path: str,
    pattern: str | None = None,
    offsets: bool = False,
    remember: int = REMEMBERED,
) -> DataFrame:
    """Every row with ``ids`` of its whole text and, if asked, the tokens' ``starts``.

    Starts are code points; the tokens of a split character all start at it. NULL and
    empty texts have no ids. Input columns named ``ids`` or ``starts`` are replaced. A
    batch passes on in parts of bounded size; a worker keeps the ids of some ``remember``
    words, which saves encoding frequent ones again.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        codec = Codec.of(path, pattern, remember)
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = codec.encode(texts)
        found = {"ids": _lists(ids)}
        if offsets:
            found["starts"] = _lists(
                [codec.starts(t, i) for t, i in zip(texts, ids, strict=True)]
            )
        return found

    rows = without(docs, "ids", "starts")
    schema = T.StructType([*rows.schema.fields]).add("ids", T.ArrayType(T.IntegerType(), False))
    if offsets:
        schema = schema.add("starts", T.ArrayType(T.IntegerType(), False))
    return rows.mapInArrow(
        over_batches(add, text_sizes), schema
    )


def decode(docs: DataFrame, path: str) -> DataFrame:
    """Every row with the ``decoded`` bytes of its ``ids``.

    Characters that are split between tokens are whole again once their bytes meet. NULL
    ids give no bytes. An input column named ``decoded`` is replaced. The text is
    ``decoded.cast("string")`` if the ids are those of a text.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        table, lists = token_bytes(path), batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        parts = [
            decode_ids(flat[a:b], table) for a, b in zip(ends - sizes, ends, strict=True)
        ]
        return {"decoded": pa.array(parts, pa.binary())}

    rows = without(docs, "decoded")
    schema = T.StructType([*rows.schema.fields]).add("decoded", T.BinaryType())
    return rows.mapInArrow(
        over_batches(add, lambda batch: pc.multiply(pc.list_value_length(batch.column("ids")), 4)),
        schema,
    )


def verified(docs: DataFrame, path: str) -> DataFrame:
    """Every row of ``encode`` with ``n_tokens`` and whether its ids give its text back."""
    decoded = decode(docs, path)
    return decoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("bigint"),
            "intact": F.col("decoded") == whole("text").cast("binary"),
        }
    ).drop("decoded")


def ids_digest(ids: str = "ids") -> Column:
    """SHA-256 of the decimal ids, joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)
