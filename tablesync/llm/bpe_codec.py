"""BPE encoding by backtracking, and decoding by an offset table.

A sequence of tokens is the encoding of a word exactly if each two neighbours are
the encoding of their joined text. So a word is encoded from the left: an
Aho-Corasick automaton gives the longest token that starts at each place in one
pass; it is taken if a table says that it may follow the token before, else the
next shorter token that starts there is tried; where none fits, the place is
marked as dead, the token before is given back and shortened. Every place dies at
most once, and tokens are of bounded length, so the time is linear in the word,
without the merges being played through. The table of compatible pairs is filled
from the merge rules when a pair is first met, and kept up to a bound.

Decoding joins slices of one blob of all token texts, cut by a table of offsets.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tablesync.llm.frames import map_batches, packed, text_of
from tablesync.llm.token_count import installed

VOCABULARY = "word_bpe_49k.json"
MAX_PAIRS, MAX_WORDS, MAX_KEPT = 500_000, 200_000, 256
#: Long texts are cut near multiples of this, where no word can be cut.
CHUNK = 1 << 16

_LAST = 0x400  # added to the last symbol of a word, where the vocabulary marks word ends
_SPACE = r"\t-\r \x85\xa0"
_CUT = regex.compile(rf"[{_SPACE}0-9]")
#: Normaliser and splitter whose words are known for Latin texts without asking the library.
_KNOWN_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_BEYOND_LATIN = regex.compile("[^\x00-ſ]")


def _byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


_SYMBOL = _byte_symbols()


class _Kept(dict):
    """Encodings of short words; memory is bounded by forgetting all now and then."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= MAX_KEPT:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts, as the library gives them for the file's settings, without added special tokens."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain BPE vocabulary")
        self.library = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks.setdefault((self.marked(a), self.marked(b)), rank)
        self.texts = {i: self.marked(token) for token, i in model["vocab"].items()}
        self.sizes = {i: len(t) for i, t in self.texts.items()}
        self.ids = {t: i for i, t in self.texts.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        #: The longest token that a token starts with.
        self.shorter = {
            i: next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1) for i, t in self.texts.items()
        }
        self.pairs: dict[int, bool] = {}
        self.by_word = _Kept(lambda word: self.encode_symbols("".join(map(_SYMBOL.__getitem__, word.encode()))))
        self.by_symbols = _Kept(self.encode_symbols)
        special = spec["added_tokens"]
        self.special = {t["content"]: array("i", [t["id"]]).tobytes() for t in special}
        odd = any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in special)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = None if odd or not special else regex.compile(f"({'|'.join(map(regex.escape, longest_first))})")
        self.by_library = odd
        parts = (spec.get("normalizer") or {}).get("normalizers", [])
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.latin = (
            [p["type"] for p in parts] == _KNOWN_NORMALIZER
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"].get("Regex") == _KNOWN_PATTERN
        )

    def marked(self, token: str) -> str:
        """The token as symbols, the mark of a word's end put into the last one."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            own = token[: -len(self.suffix)]
            return own[:-1] + chr(ord(own[-1]) + _LAST)
        return token

    def merged(self, text: str) -> list[str]:
        """The encoding by its definition: the pair of the lowest rank first, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranked)
            if best == 1 << 60:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: begin a word)."""
        key = (before << 32) + token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            wanted = [self.texts[t] for t in (before, token) if t >= 0]
            known = self.pairs[key] = self.merged("".join(wanted)) == wanted
        return known

    def encode_symbols(self, word: str) -> bytes:
        """Ids of one word, as 32-bit numbers."""
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + _LAST)
        longest = array("i", [-1]) * len(word)
        for end, token in self.automaton.iter(word):
            longest[end - self.sizes[token] + 1] = token  # later ends are longer tokens
        dead = bytearray(len(word) + 1)
        out, at, token = array("i"), 0, longest[0]
        while at < len(word):
            before = out[-1] if out else -1
            while token >= 0 and (dead[at + self.sizes[token]] or not self.fits(before, token)):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += self.sizes[token]
                token = longest[at] if at < len(word) else -1
            elif out:
                dead[at] = 1
                token = out.pop()
                at -= self.sizes[token]
            else:
                raise ValueError("a symbol isn't in the vocabulary")
        return out.tobytes()

    def _chunks(self, text: str) -> Iterator[str]:
        """White space and digits part words, whatever stands beside them."""
        start = 0
        while self.latin and len(text) - start > CHUNK:
            cut = _CUT.search(text, start + CHUNK)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def _plain(self, text: str) -> Iterator[bytes]:
        for chunk in self._chunks(text):
            if self.latin and _BEYOND_LATIN.search(chunk) is None:
                yield b"".join(map(self.by_word.__getitem__, _WORD.findall(chunk.lower())))
                continue
            normal = self.library.normalizer.normalize_str(chunk) if self.library.normalizer else chunk
            split = self.library.pre_tokenizer.pre_tokenize_str(normal)
            yield b"".join(self.by_symbols[piece] for piece, _ in split)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as 32-bit numbers; special tokens that stand in it are one id each."""
        if self.by_library:
            return array("i", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if self.cut_special is None or self.cut_special.search(text) is None:
            return b"".join(self._plain(text))
        pieces = self.cut_special.split(text)
        return b"".join(self.special[p] if k % 2 else b"".join(self._plain(p)) for k, p in enumerate(pieces))


class Decoder:
    """Texts of ids, special tokens included; ids that are in no table give nothing."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        kind = (spec.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"a decoder of type {kind} isn't known")
        self.bytes = kind == "ByteLevel"
        names = {i: name for name, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        byte_of = {symbol: b for b, symbol in enumerate(_SYMBOL)}
        parts = []
        for i in range(max(names) + 1):
            name = names.get(i, "")
            if not self.bytes:
                parts.append(f"{name} ".encode() if i in names else b"")  # without a decoder, blanks part tokens
            elif all(c in byte_of for c in name):
                parts.append(bytes(map(byte_of.__getitem__, name)))
            else:
                parts.append(name.encode())
        self.offsets = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=self.offsets[1:])
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text in UTF-8."""
        out = []
        for at in range(0, len(ids), CHUNK):
            own = ids[at : at + CHUNK].astype(np.int64)
            own = own[(own >= 0) & (own < len(self.offsets) - 1)]
            first, size = self.offsets[own], self.offsets[own + 1] - self.offsets[own]
            ends = np.cumsum(size)
            place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first, size)
            out.append(self.blob[place].tobytes())
        text = b"".join(out)
        return text.decode(errors="replace").encode() if self.bytes else text[:-1]


_known: dict[tuple, object] = {}


def _of(kind, path: str):
    """One encoder or decoder for each file and worker."""
    if (kind, path) not in _known:
        _known[kind, path] = kind(path)
    return _known[kind, path]


def _encoding(place: Callable[[str], str], name: str, columns: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of(Encoder, place(name))
        for batch in batches:
            found = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(f) // 4 for f in found)])
            ids = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(found), np.int32)))
            ids = ids.cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), ids], names=[*columns, "ids"])

    return encode


def encode_texts(
    docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, place: Callable[[str], str] = installed
) -> DataFrame:
    """``row`` and ``ids`` of every row; no shuffle.

    ``place`` gives the path of ``vocabulary`` on the worker. The ids are those of
    the library without added special tokens, truncation and padding; special
    tokens that stand in a text are one id each. Null and empty texts have no
    ids. Rows, repeated ones too, stay as they are, whatever their columns.
    """
    base = packed(docs, text=text_col).withColumn("text", text_of())
    schema = T.StructType([base.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return map_batches(base, _encoding(place, vocabulary, ["row"]), schema)


def _decoding(place: Callable[[str], str], name: str, ids_col: str, out_col: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _of(Decoder, place(name))
        for batch in batches:
            texts = []
            for own in batch.column(ids_col):
                texts.append(decoder.decode(np.asarray(own.values.drop_null(), np.int64)) if own.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, out_col]
            )

    return decode


def decode_ids(
    encoded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", vocabulary: str = VOCABULARY,
    place: Callable[[str], str] = installed,
) -> DataFrame:
    """All columns and the text of ``ids_col`` in ``out_col``; no shuffle.

    Special tokens are kept. Unknown ids and nulls in a list give nothing; a
    null list has a null text, an empty one the empty text. ``out_col`` must be new.
    """
    if out_col.lower() in (c.lower() for c in encoded.columns):
        raise ValueError(f"there is a column {out_col}")
    schema = T.StructType([*encoded.schema, T.StructField(out_col, T.StringType())])
    return map_batches(encoded, _decoding(place, vocabulary, ids_col, out_col), schema)
