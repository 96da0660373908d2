"""SentencePiece encoding and decoding with merge-type vocabularies.

A text is a row of symbols, at first its characters. An agenda holds every adjacent pair whose
joined string is a piece, best score first and leftmost among equals; the pair on top is joined and
its new neighbours enter the agenda, until it is empty. Symbols that are no piece become byte pieces.

No piece can hold two neighbouring characters that stand together in no piece of the vocabulary, so
a text may be cut between them: first in front of blanks into words, then into parts. A worker
remembers both, and holds the words it had not met against the sentencepiece library, batch by batch.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_schema, batch_of, small, spark_schema
from .remembered import Remembered

SPACE = "▁"
#: Words, and parts of words, in a generation of those a worker remembers, and the longest kept.
CACHED_WORDS = 500_000
CACHED_LENGTH = 48


def public_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pairs:
    """Which pairs of symbols join, in what order, and to what.

    Symbols are numbers below ``base``. ``order`` gives a pair its place among all scores, best first;
    equal scores have equal places.
    """

    def __init__(self, scores: dict[str, float], numbers: dict[str, int], base: int):
        places = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.base, self.order, self.joined = base, {}, {}
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = numbers.get(piece[:cut]), numbers.get(piece[cut:])
                if left is not None and right is not None:
                    self.order[left * base + right] = places[score]
                    self.joined[left * base + right] = numbers[piece]

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all joins."""
        symbols, n, base = list(symbols), len(symbols), self.base
        order_of = self.order.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [
            order * n + i
            for i, (x, y) in enumerate(pairwise(symbols))
            if (order := order_of(x * base + y)) is not None
        ]
        heapify(agenda)
        while agenda:
            order, left = divmod(heappop(agenda), n)
            right = after[left]
            if right == n or symbols[left] < 0:
                continue
            pair = symbols[left] * base + symbols[right]
            # A pair whose symbols have been joined with others since is out of date.
            if order_of(pair) != order:
                continue
            symbols[left], symbols[right] = self.joined[pair], -1
            after[left] = behind = after[right]
            front = before[left]
            if behind < n:
                before[behind] = left
                if (order := order_of(symbols[left] * base + symbols[behind])) is not None:
                    heappush(agenda, order * n + left)
            if front >= 0 and (order := order_of(symbols[front] * base + symbols[left])) is not None:
                heappush(agenda, order * n + front)
        return [s for s in symbols if s >= 0]


class MergeVocabulary:
    """A merge-type model with byte pieces and no user-defined symbols.

    The model must leave characters as they are but for blanks, and put one blank before a text.
    ``unlike`` holds the words whose ids the library did not confirm.
    """

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model)
        self.unlike: set[str] = set()
        self._unconfirmed: dict[str, bytes] = {}
        self._byte_ids, self._ids, scores = {}, {}, {}
        self.bytes: list[bytes] = []
        for i in range(self.library.vocab_size()):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self._byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.library.is_control(i) or self.library.is_unknown(i):
                self.bytes.append(b"")
            else:
                self._ids[piece] = i
                scores[piece] = self.library.get_score(i)
                self.bytes.append(piece.replace(SPACE, " ").encode())
        # One number more stands for characters that are no piece.
        self._unknown = len(self.bytes)
        self._pairs = Pairs(scores, self._ids, self._unknown + 1)
        self._together = {a + b for piece in self._ids for a, b in pairwise(piece)}
        spans = any(a != SPACE and b == SPACE for a, b in self._together)
        self._border = None if spans else re.compile(f"(?<=[^{SPACE}])(?={SPACE})")
        self._words = Remembered(self._word, CACHED_WORDS, CACHED_LENGTH)
        self._parts = Remembered(self._part, CACHED_WORDS, CACHED_LENGTH)

    def words(self, text: str) -> list[str]:
        """The text with its blank in front, cut where no piece crosses."""
        if not text:
            return []
        if self._border and text[0] != " " and "  " not in text and SPACE not in text:
            return [SPACE + word for word in text.split(" ")]
        shown = SPACE + text.replace(" ", SPACE)
        return self._border.split(shown) if self._border else [shown]

    def _word_ids(self, word: str) -> bytes:
        cuts = [i for i, pair in enumerate(map(str.__add__, word, word[1:]), 1) if pair not in self._together]
        if not cuts:
            return self._part(word)
        first, *rest = (word[a:b] for a, b in pairwise([0, *cuts, len(word)]))
        # The first part is a word too: it has the blank in front.
        return b"".join([self._words[first], *map(self._parts.__getitem__, rest)])

    def _word(self, word: str) -> bytes:
        found = self._unconfirmed[word] = self._word_ids(word)
        return found

    def _part(self, part: str) -> bytes:
        symbols = [self._ids.get(c, self._unknown) for c in part]
        ids = self._pairs.merge(symbols)
        if self._unknown in ids:
            strange = iter([c for c in part if c not in self._ids])
            ids = [j for i in ids for j in ([i] if i != self._unknown else self._spelt(next(strange)))]
        return array("I", ids).tobytes()

    def _spelt(self, character: str) -> list[int]:
        return [self._byte_ids[b] for b in character.encode()]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; None is an empty text."""
        return np.frombuffer(self.encode_words(self.words(text or "")), dtype="<u4")

    def encode_words(self, words: list[str]) -> bytes:
        return b"".join(map(self._words.__getitem__, words))

    def confirm(self) -> None:
        """Hold the words encoded since the last call against the library, all at once."""
        words = list(self._unconfirmed)
        theirs = self.library.encode([w[1:].replace(SPACE, " ") for w in words], num_threads=1)
        for word, ids in zip(words, theirs, strict=True):
            # An empty text has no ids, a blank alone its piece.
            ids = [self._ids[SPACE]] if word == SPACE and SPACE in self._ids else ids
            if np.array(ids, dtype="<u4").tobytes() != self._unconfirmed[word]:
                self.unlike.add(word)
        self._unconfirmed.clear()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: blanks for their sign, without the one in front; bytes that are no
        character become U+FFFD."""
        whole = b"".join(map(self.bytes.__getitem__, ids))
        return whole.removeprefix(b" ").decode("utf-8", "replace")


_VOCABULARIES: dict[str, MergeVocabulary] = {}


def vocabulary(model: str) -> MergeVocabulary:
    """The worker's vocabulary for a model file; it lives as long as the worker."""
    if model not in _VOCABULARIES:
        _VOCABULARIES[model] = MergeVocabulary(model)
    return _VOCABULARIES[model]


_CODED = arrow_schema(doc_id="int64", ids=pa.list_(pa.int32()), decoded="string", agrees="bool")
_DIGESTS = arrow_schema(
    doc_id="int64", n_tokens="int64", ids_sha256="string", decoded_sha256="string", agrees="bool"
)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_documents(docs: DataFrame, model: str, digests: bool = False) -> DataFrame:
    """``doc_id``, ``ids``, ``decoded`` and ``agrees`` of every row, in whole texts.

    With ``digests`` the ids and the decoded text give way to ``n_tokens``, ``ids_sha256`` (of the
    decimal ids joined by commas) and ``decoded_sha256``. ``agrees`` says whether the library, asked
    batch by batch, gives the same ids for each word that the worker had not met before, and decodes
    the whole text's ids alike. A null text is an empty one and has no ids; repeated rows are encoded
    each, null ids stay null; other columns are not read. The work is a map, so a lost executor costs
    its batches only.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model)
        for batch in small(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            encoded = [own.encode(text).tolist() for text in texts]
            own.confirm()
            library = own.library.decode(encoded, num_threads=1) if encoded else []
            rows = []
            for doc_id, text, ids, theirs in zip(
                batch["doc_id"].to_pylist(), texts, encoded, library, strict=True
            ):
                decoded = own.decode(ids)
                agrees = decoded == theirs and own.unlike.isdisjoint(own.words(text) if own.unlike else ())
                if digests:
                    joined = ",".join(map(str, ids))
                    rows.append((doc_id, len(ids), _sha256(joined), _sha256(decoded), agrees))
                else:
                    rows.append((doc_id, ids, decoded, agrees))
            yield batch_of(rows, _DIGESTS if digests else _CODED)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(encode, spark_schema(_DIGESTS if digests else _CODED))
