"""Exact BPE of words in linear time: longest matches, checked pair by pair, with backtracking."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataflow.llm.bpe import byte_characters, over_batches, text_sizes
from strataflow.llm.common import without

#: Chunks between white space, and pairs of tokens, that a worker remembers.
REMEMBERED = 400_000
#: Characters of a text that are cut up at a time, about.
SLICE_CHARACTERS = 500_000
#: Ids that are decoded at a time.
SLICE_IDS = 500_000
# Code points with the Unicode property White_Space, and the marks between
# which str.split cuts as well.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_NO_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
# Characters that are in NFC and have a lower case of their own kind whatever
# stands beside them, and the letters and numbers among the lower ones.
_PLAIN = re.compile("[!-~\xa1-\u012f\u0131-\u017f]*")
_PLAIN_LETTER, _PLAIN_NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
# The steps of a vocabulary for which plain chunks are cut up here.
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}]
_STEPS += [{"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_CUT = re.compile(
    _CUT.replace(r"\p{L}", _PLAIN_LETTER).replace(r"\p{N}", _PLAIN_NUMBER)
)
# Symbols of bytes that end a word lie in the private use area; the separator is no symbol.
_LAST, _APART = 0xE000, "\x00"


class Merges:
    """The merges of a vocabulary as tables over tokens, numbered in the order of their merges.

    A token that its own text would not be encoded to is never used.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str) -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = ["".join(p) for p in pairs]
        if len(set(made)) != len(made):
            raise ValueError("two merges make the same token")
        base = sorted(set(vocabulary).difference(made), key=vocabulary.__getitem__)
        names = base + made
        number = {name: k for k, name in enumerate(names)}
        self.ids = np.array([vocabulary[name] for name in names], "<u4")
        self.n_base = len(base)
        self.left = [-1] * len(base) + [number[a] for a, _ in pairs]
        self.right = [-1] * len(base) + [number[b] for _, b in pairs]
        self.made_of = {
            (a, b): k
            for k, (a, b) in enumerate(zip(self.left, self.right, strict=True))
            if a >= 0
        }
        self._known: dict[int, bool] = {}
        symbols: list[str] = []
        for k, name in enumerate(names):
            if k >= len(base):
                symbols.append(symbols[self.left[k]] + symbols[self.right[k]])
            elif len(name) > 1 and name.endswith(suffix):
                symbols.append(self.ended(name[: -len(suffix)]))
            else:
                symbols.append(name)
        usable: list[bool] = []
        for k in range(len(names)):
            usable.append(
                len(symbols[k]) == 1
                if k < len(base)
                else usable[self.left[k]]
                and usable[self.right[k]]
                and self._apart(self.left[k], self.right[k], k)
            )
        self.length = [len(s) for s in symbols]
        self.number = {s: k for k, s in enumerate(symbols) if usable[k]}
        self.shorter = [self._longest_prefix(s) for s in symbols]
        # Matches that end at a place of the reversed text start there in the text.
        self.starting = ahocorasick.Automaton()
        for symbol, k in self.number.items():
            self.starting.add_word(symbol[::-1], k)
        self.starting.make_automaton()

    @staticmethod
    def ended(word: str) -> str:
        """The symbols of a word, the last one marked."""
        return word[:-1] + chr(_LAST + ord(word[-1]))

    def _longest_prefix(self, symbol: str) -> int:
        for size in range(len(symbol) - 1, 0, -1):
            found = self.number.get(symbol[:size])
            if found is not None:
                return found
        return -1

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge before ``limit`` joins two neighbours across their border.

        Merges are undone from the last on. The two tokens at the border stood side by side
        until one of them was merged away from it; an earlier merge of the two comes first.
        Of equal merges the left one comes first.
        """
        while True:
            if self.made_of.get((a, b), limit) < limit:
                return False
            if max(a, b) < self.n_base:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        """Whether one token may follow the other: the table of pairs, filled as they come up."""
        key = a * len(self.left) + b
        known = self._known.get(key)
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known = dict(islice(self._known.items(), REMEMBERED // 2))
            known = self._known[key] = self._apart(a, b, len(self.left))
        return known

    def _longest(self, line: str) -> list[int]:
        """The longest token that starts at each place."""
        longest, length, end = [-1] * len(line), self.length, len(line) - 1
        for at, token in self.starting.iter(line[::-1]):
            before = longest[end - at]
            if before < 0 or length[token] > length[before]:
                longest[end - at] = token
        return longest

    def encode(self, words: list[str]) -> Iterator[list[int]]:
        """Tokens of each word, given as symbols.

        From the left, the longest token that may follow the one before is taken; where
        none may, that place is closed and the token before it gives way to a shorter one.
        Each place closes once, so the time is linear in the word.
        """
        longest = self._longest(_APART.join(words))
        start = 0
        for word in words:
            yield self._tokens(word, longest[start : start + len(word)])
            start += len(word) + 1

    def _tokens(self, word: str, longest: list[int]) -> list[int]:
        whole = self.number.get(word)
        if whole is not None:
            return [whole]
        end, length, compatible = len(word), self.length, self.compatible
        tokens: list[int] = []
        still_open = bytearray(b"\x01") * (end + 1)
        at, token = 0, longest[0]
        while at < end:
            before = tokens[-1] if tokens else -1
            while token >= 0:
                stop = at + length[token]
                if still_open[stop] and (before < 0 or compatible(before, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                tokens.append(token)
                at = stop
                token = longest[at] if at < end else -1
            elif not tokens:
                raise ValueError(f"no tokens for {word[:80]!r}")
            else:
                still_open[at] = 0
                token = tokens.pop()
                at -= length[token]
        return tokens


class WordCodec:
    """Encodes texts to ids and back as the tokenizers library does, in one worker.

    For vocabularies that drop white space and mark the ends of words.
    """

    _loaded: dict[tuple, WordCodec] = {}

    def __init__(self, path: str, remember: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self._check(config)
        model = config["model"]
        library = Tokenizer.from_file(path)
        self._normalise = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self._special = {t["content"]: t["id"] for t in config["added_tokens"]}
        literal = sorted(map(re.escape, self._special), key=len, reverse=True)
        self._special_in = re.compile("(" + "|".join(literal) + ")") if literal else None
        self.remember = remember
        self._chunks: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._shown = dict(enumerate(byte_characters()))
        self._cuts_plain = (
            config["normalizer"] == {"type": "Sequence", "normalizers": _STEPS}
            and config["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": _CUT}
        )
        self._tables(model["vocab"] | self._special)

    @staticmethod
    def _check(config: dict) -> None:
        """Raise where cutting at white space would change the ids, or a step is unknown."""
        model, steps = config["model"], (config["pre_tokenizer"] or {}).get("pretokenizers", [])
        fits = (
            model["type"] == "BPE"
            and model["end_of_word_suffix"]
            and not model["dropout"]
            and not model["ignore_merges"]
            and config["decoder"] is None
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
            and not any(
                t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                or _SPACE.search(t["content"])
                for t in config["added_tokens"]
            )
        )
        if not fits:
            raise ValueError("not a BPE of words that drops white space")

    def _tables(self, vocabulary: dict[str, int]) -> None:
        """Every token's text and a blank in one array, and where each id's part starts."""
        texts = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, number in vocabulary.items():
            texts[number] = token.encode() + b" "
        self._blob = np.frombuffer(b"".join(texts), np.uint8)
        self._offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)

    @classmethod
    def of(cls, path: str, remember: int = REMEMBERED) -> WordCodec:
        """The worker's codec, loaded once."""
        key = (path, remember)
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def _cut_plain(self, chunks: list[str]) -> Iterator[list[str]]:
        """The matches in each of some plain chunks."""
        yield from map(_PLAIN_CUT.findall, "\n".join(chunks).lower().split("\n"))

    def _cut_other(self, chunks: list[str]) -> Iterator[list[str]]:
        """The matches in each chunk, by the library, as bytes shown by characters.

        Chunks are normalised and split together: neither step reaches across white space.
        """
        text = self._normalise(" ".join(chunks))
        parts = text.split(" ")
        if len(parts) != len(chunks):
            raise ValueError("the normaliser adds or drops white space")
        pieces = self._split(text)
        at, n_pieces, end = 0, len(pieces), 0
        for part in parts:
            end += len(part)
            start = at
            while at < n_pieces and pieces[at][1][0] < end:
                at += 1
            yield [piece for piece, _ in pieces[start:at]]
            end += 1

    def _learn_pieces(self, new: list[str], shown: list[str]) -> None:
        """Remember the ids of matches, given also as bytes shown by characters."""
        ids, ended = self.merges.ids, self.merges.ended
        encoded = self.merges.encode(list(map(ended, shown)))
        tokens = list(encoded)
        flat = ids[list(chain.from_iterable(tokens))].tobytes()
        start = 0
        for piece, some in zip(new, tokens, strict=True):
            stop = start + 4 * len(some)
            self._pieces[piece] = flat[start:stop]
            start = stop

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks without white space or special tokens."""
        if len(self._pieces) > self.remember:
            self._pieces = dict(islice(self._pieces.items(), self.remember // 2))
        plain = [c for c in chunks if self._cuts_plain and _PLAIN.fullmatch(c)]
        cut = list(self._cut_plain(plain)) if plain else []
        new = list(set(chain.from_iterable(cut)).difference(self._pieces))
        if new:
            shown = "\n".join(new).encode().decode("latin-1").translate(self._shown)
            self._learn_pieces(new, shown.split(self._shown[ord("\n")]))
        known = self._pieces.__getitem__
        for chunk, pieces in zip(plain, cut, strict=True):
            self._chunks[chunk] = b"".join(map(known, pieces))
        other = list(set(chunks).difference(plain))
        if other:
            cut = list(self._cut_other(other))
            flat = list(chain.from_iterable(cut))
            found = iter(self.merges.encode(list(map(self.merges.ended, flat))))
            for chunk, pieces in zip(other, cut, strict=True):
                tokens = list(chain.from_iterable(islice(found, len(pieces))))
                self._chunks[chunk] = self.merges.ids[tokens].tobytes()

    def _special_parts(self, chunk: str) -> list[str]:
        return [p for p in self._special_in.split(chunk) if p]

    def _slice_ids(self, text: str) -> bytes:
        odd = any(c in text for c in _NO_SPACE)
        chunks = [c for c in _SPACE.split(text) if c] if odd else text.split()
        if self._special_in and self._special_in.search(text):
            chunks = [p for c in chunks for p in self._special_parts(c)]
            self._chunks.update(
                (t, np.array([i], "<u4").tobytes()) for t, i in self._special.items()
            )
        known = self._chunks
        new = list({c for c in chunks if c not in known})
        if new:
            self._learn(new)
        return b"".join(map(known.__getitem__, chunks))

    @staticmethod
    def _slices(text: str) -> Iterator[str]:
        """Parts of about ``SLICE_CHARACTERS``, cut before white space."""
        start = 0
        while len(text) - start > SLICE_CHARACTERS:
            gap = _SPACE.search(text, start + SLICE_CHARACTERS)
            if gap is None:
                break
            yield text[start : gap.start()]
            start = gap.start()
        yield text[start:] if start else text

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        found = []
        for part in self._slices(text):
            if len(self._chunks) > self.remember:  # frequent ones come up early
                self._chunks = dict(islice(self._chunks.items(), self.remember // 2))
            found.append(self._slice_ids(part))
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with blanks between; ids without a token are left out."""
        found = []
        for start in range(0, len(ids), SLICE_IDS):
            some = ids[start : start + SLICE_IDS].astype(np.int64)
            some = some[(some >= 0) & (some < len(self._offsets) - 1)]
            sizes = self._offsets[some + 1] - self._offsets[some]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            shift = np.repeat(self._offsets[some] - (ends - sizes), sizes)
            found.append(self._blob[shift + np.arange(total)].tobytes())
        return b"".join(found)[:-1]


def encode(docs: DataFrame, path: str, remember: int = REMEMBERED) -> DataFrame:
    """Every row with ``ids`` of its whole text: little-endian unsigned 32-bit integers.

    Ids are those of the tokenizers library with its defaults and without added special
    tokens: a special token's own text is that token. NULL, empty and blank texts have no
    ids. An input column named ``ids`` is replaced. Texts are cut up in slices and batches
    pass on in parts of bounded size; a worker keeps the ids of some ``remember`` chunks.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        codec = WordCodec.of(path, remember)
        found = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
        return {"ids": pa.array(found, pa.binary())}

    rows = without(docs, "ids")
    schema = T.StructType([*rows.schema.fields]).add("ids", T.BinaryType())
    return rows.mapInArrow(over_batches(add, text_sizes), schema)


def decode(docs: DataFrame, path: str) -> DataFrame:
    """Every row with the ``decoded`` text of its ``ids``, as ``encode`` packs them.

    The tokens' texts with a blank between, as the library joins them for a vocabulary
    without a decoder. NULL ids give an empty text, ids without a token are left out. An
    input column named ``decoded`` is replaced.
    """

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        codec = WordCodec.of(path)
        found = [
            codec.decode(np.frombuffer(packed or b"", "<u4")).decode()
            for packed in batch.column("ids").to_pylist()
        ]
        return {"decoded": pa.array(found, pa.string())}

    rows = without(docs, "decoded")
    schema = T.StructType([*rows.schema.fields]).add("decoded", T.StringType())
    return rows.mapInArrow(
        over_batches(add, lambda batch: pa.compute.binary_length(batch.column("ids"))), schema
    )
