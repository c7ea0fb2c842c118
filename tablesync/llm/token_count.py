"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The transducer reads bytes; the last byte of a word is a symbol of its own, since
the vocabulary marks word ends. A state holds, for every start of a token that
may still be completed, its place in the trie of tokens, the token before it and
how many tokens it would save or cost; each transition is annotated with the
number of tokens that it adds to the count. This is deterministic because the
encoding of a prefix is unique, and two tokens may follow each other exactly if
encoding their joined bytes gives the two again. States and transitions are
compiled when they are first needed and kept by the worker, up to a bound.

A long text is cut into chunks. The map of a chunk is no table over the states in
which it may be entered: it holds the text before its first and after its last
boundary of words, and the tokens between, which no neighbour changes. A fold over
the chunks counts what lies between their boundaries and keeps only a running
total and the text that is still open. Blanks and digits are boundaries; a run
without any is counted in one go.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tablesync.llm.frames import map_batches, packed, text_of

CHUNK = 1 << 16
MAX_STATES, MAX_WORDS = 400_000, 1_000_000

_END = 256  # added to the last byte of a word
_SPACE = r"\t-\r \x85\xa0"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Beyond this range the library itself normalises and cuts into words, in its own version of Unicode.
_BEYOND = regex.compile("[^\x00-ſ]")
#: White space parts words, and each digit is a word of its own, whatever stands beside it.
_CUT = regex.compile(rf"[{_SPACE}0-9]")
#: Longer words are counted anew each time, as keeping them would take much memory.
_KEPT_BYTES = 1024


def _byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


_BYTES = _byte_characters()

Symbols = tuple[int, ...]


class Transducer:
    """Bytes of words to numbers of tokens; ``vocabulary`` and ``merges`` as in the file."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.ranks: dict[tuple[Symbols, Symbols], int] = {}
        for rank, (a, b) in enumerate(merges):
            self.ranks.setdefault((self.symbols(a), self.symbols(b)), rank)
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        self.tokens: list[Symbols] = []
        for name in vocabulary:
            node = 0
            for symbol in self.symbols(name):
                if symbol not in self.trie[node]:
                    self.trie[node][symbol] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(-1)
                node = self.trie[node][symbol]
            self.token_at[node] = len(self.tokens)
            self.tokens.append(self.symbols(name))
        self._pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Back to the start state alone."""
        self.start = ((0, -1, 0),)
        self.ids = {self.start: 0}
        self.states = [self.start]
        self.steps: list[dict[int, tuple[int, int]]] = [{}]
        self.words: dict[bytes, int] = {}

    def symbols(self, name: str) -> Symbols:
        ends = name.endswith(self.suffix) and len(name) > len(self.suffix)
        own = [_BYTES[c] for c in (name[: -len(self.suffix)] if ends else name)]
        return (*own[:-1], own[-1] + _END) if ends else tuple(own)

    def merged(self, parts: list[Symbols]) -> list[Symbols]:
        """The encoding by its definition: the pair of the lowest rank first, leftmost first."""
        while len(parts) > 1:
            ranked = [self.ranks.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            best = min(ranked)
            if best == 1 << 60:
                break
            at = ranked.index(best)
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
        return parts

    def may_follow(self, a: int, b: int) -> bool:
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= 4 * MAX_WORDS:
                self._pairs.clear()
            one, two = self.tokens[a], self.tokens[b]
            known = self._pairs[a, b] = self.merged([(s,) for s in one + two]) == [one, two]
        return known

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The transition on ``symbol``: next state (0 after a word's end) and tokens added."""
        live, last, added = [], None, 0
        for node, before, saved in self.states[state]:
            child = self.trie[node].get(symbol)
            if child is None:
                continue
            live.append((child, before, saved))
            token = self.token_at[child]
            if token >= 0 and last is None and (before < 0 or self.may_follow(before, token)):
                last, added = token, saved + 1
        if symbol >= _END:
            after = self.start
        else:
            after = (*((n, b, s - added) for n, b, s in live if self.trie[n]), (0, last, 0))
        if after not in self.ids:
            self.ids[after] = len(self.states)
            self.states.append(after)
            self.steps.append({})
        step = self.steps[state][symbol] = (self.ids[after], added)
        return step

    def run(self, word: bytes, state: int = 0, ends: bool = True) -> tuple[int, int]:
        """State and tokens after ``word``, whose last byte ends it if ``ends``."""
        total = 0
        for symbol in word[:-1] if ends else word:
            step = self.steps[state].get(symbol) or self.compile(state, symbol)
            state = step[0]
            total += step[1]
        if ends:
            step = self.steps[state].get(word[-1] + _END) or self.compile(state, word[-1] + _END)
            return 0, total + step[1]
        return state, total

    def count(self, word: bytes) -> int:
        """Tokens of a whole word: the transducer's way from the start state back to it."""
        known = self.words.get(word)
        if known is None:
            if len(self.states) > MAX_STATES or len(self.words) > MAX_WORDS:
                self.forget()
            known = self.run(word)[1]
            if len(word) <= _KEPT_BYTES:
                self.words[word] = known
        return known


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the open text it is entered in.

    ``head`` and ``tail`` are the texts before the first and after the last
    word boundary, ``inner`` the tokens between. Without any boundary the chunk
    is all ``head`` and ``tail`` is None.
    """

    head: str
    inner: int
    tail: str | None


class Counter:
    """Token counts of texts, as the library gives them for the file's settings."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], merges, model["end_of_word_suffix"])
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def words(self, text: str) -> Iterator[bytes]:
        if _BEYOND.search(text) is None:
            found = _WORD.findall(text.lower()) if len(text) <= CHUNK else (m[0] for m in _WORD.finditer(text.lower()))
            return (w.encode() for w in found)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return (bytes(_BYTES[c] for c in piece) for piece, _ in pieces)

    def plain(self, text: str) -> int:
        return sum(map(self.transducer.count, self.words(text)))

    def map_of(self, chunk: str) -> ChunkMap:
        """The map of a chunk. Boundaries that no neighbour can shift are white space and digits."""
        first = _CUT.search(chunk)
        if first is None:
            return ChunkMap(chunk, 0, None)
        last = next(i for i in range(len(chunk) - 1, -1, -1) if _CUT.match(chunk[i]))
        return ChunkMap(chunk[: first.start()], self.plain(chunk[first.start() : last + 1]), chunk[last + 1 :])

    def composed(self, one: ChunkMap, two: ChunkMap) -> ChunkMap:
        """Associative: first ``one``, then ``two``."""
        if one.tail is None:
            return ChunkMap(one.head + two.head, two.inner, two.tail)
        if two.tail is None:
            return ChunkMap(one.head, one.inner, one.tail + two.head)
        return ChunkMap(one.head, one.inner + self.plain(one.tail + two.head) + two.inner, two.tail)

    def scanned(self, maps: list[ChunkMap]) -> list[ChunkMap]:
        """Inclusive prefix scan, in rounds of doubled distance; each round's steps are independent."""
        distance = 1
        while distance < len(maps):
            maps = maps[:distance] + [
                self.composed(maps[i - distance], maps[i]) for i in range(distance, len(maps))
            ]
            distance *= 2
        return maps

    def segment(self, text: str) -> int:
        if len(text) <= CHUNK:
            return self.plain(text)
        total, open_ = 0, []
        for i in range(0, len(text), CHUNK):
            own = self.map_of(text[i : i + CHUNK])
            open_.append(own.head)
            if own.tail is not None:
                total += self.plain("".join(open_)) + own.inner
                open_ = [own.tail]
        return total + self.plain("".join(open_))

    def count(self, text: str) -> int:
        if self.special is None or "<|" not in text:
            return self.segment(text)
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(map(self.segment, pieces))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One for each file and worker."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def _counting(place: Callable[[str], str], name: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(place(name))
        for batch in batches:
            counts = [tokens.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["row", "n_bytes", "n_tokens"],
            )

    return count


def installed(name: str) -> str:
    """The place of a vocabulary file where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    place: Callable[[str], str] = installed,
) -> DataFrame:
    """``row``, ``n_bytes`` and ``n_tokens`` of every row; no shuffle.

    ``place`` gives the path of ``vocabulary`` on the worker. Special tokens are
    not added, but those that stand in a text count as one token each. Null and
    empty texts have no bytes and no tokens.
    """
    base = packed(docs, text=text_col).withColumn("text", text_of())
    base = base.withColumn("n_bytes", F.octet_length("text").cast("long"))
    schema = T.StructType([base.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return map_batches(base, _counting(place, vocabulary), schema)
