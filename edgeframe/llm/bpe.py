"""BPE encoding and decoding: propose by greedy longest match, verify pairs, merge what fails.

A word is cut greedily into the longest vocabulary entries. Such a cut is the BPE result if and
only if every entry encodes to itself and every adjacent pair of entries encodes to just those
two: the first merge that crossed a border would also happen when the two neighbours stand
alone. Pairs are judged once and remembered, as sorted arrays, so checking all pairs of all new
words of a batch is one ``searchsorted``. Words with a failing pair are merged step by step.

Texts are cut at ASCII white space first: no token, normalisation or added token spans it. A
batch of texts is cut, and its pieces are numbered, as Arrow arrays; each distinct piece of a batch
is looked up once in a table of bounded size that a worker keeps, and the ids of all texts are
gathered in one pass. New pieces of plain Latin-1 letters, with marks after them or not, are
normalised and split as arrays too; any other piece goes through the normaliser and
pre-tokenizer the vocabulary file names, so Unicode details are those of that file.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeframe.llm.common import kept_in_worker

#: Distinct pieces a worker remembers before it starts anew; bounds its memory, not its results.
MEMORY = 1_000_000
#: Bytes of texts that are encoded together, unless a single text is longer.
GROUP_BYTES = 6 << 20

# What the byte-level alphabet maps to itself.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Letters of this range have one normal form and one lower case in every Unicode version.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_PLAIN_ONLY = "^[\x01-\x7fÀ-ÖØ-öø-ÿ]*$"
#: Letters, then what is neither letter nor digit: at most two words, with nothing to contract.
_TWO_WORDS = "^(?P<word>[a-zß-öø-ÿ]*)(?P<mark>[^ \t\n\r\x0b\x0c\x00a-z0-9ß-öø-ÿ]*)$"
_SPLIT = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\r\x0b\x0c\x00a-z0-9ß-öø-ÿ]+|\x00+"
)


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    spare = iter(range(256, 512))
    printable = set(PRINTABLE)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merges and added tokens of a vocabulary file (its text is passed, not its path)."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        self.text = text
        self.ids: dict[str, int] = dict(model["vocab"])
        self.end: str = model.get("end_of_word_suffix") or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*self.ids.values(), *self.added.values()])
        self.names = [""] * size
        for name, i in {**self.ids, **self.added}.items():
            self.names[i] = name
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}

    def symbols(self, name: str) -> list[int] | None:
        """The places of a token: a byte, plus 256 if it ends a word. None if it is no bytes."""
        last = bool(self.end) and name.endswith(self.end) and len(name) > len(self.end)
        bytes_ = [self.byte_of.get(c) for c in (name[: -len(self.end)] if last else name)]
        if None in bytes_ or not bytes_:
            return None
        if last:
            bytes_[-1] += 256
        return bytes_

    def symbol_ids(self) -> np.ndarray:
        """The id of each of the 512 symbols; -2 where the vocabulary has none."""
        plain = [self.ids.get(c, -2) for c in self.letters]
        ending = [self.ids.get(c + self.end, -2) for c in self.letters]
        return np.array(plain + ending, np.int32)


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every cell of rows of these sizes."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Merges:
    """The exact rule for many words at once: join the leftmost pair of lowest rank, repeatedly."""

    NEVER = np.iinfo(np.int32).max
    ROWS = 4096

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids, self._size = vocabulary.ids, len(vocabulary.names)
        found = [(a, b, r) for (a, b), r in vocabulary.ranks.items() if a + b in ids]
        keys = np.array([ids[a] * self._size + ids[b] for a, b, _ in found], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.array([r for *_, r in found], np.int32)[order]
        self._joined = np.full(1 + max(vocabulary.ranks.values(), default=0), -1, np.int32)
        for a, b, rank in found:
            self._joined[rank] = ids[a + b]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self._size + right
        at = np.searchsorted(self._keys, keys)
        held = (self._keys[at] == keys) & (left >= 0) & (right >= 0)
        ranks = np.full(keys.shape, self.NEVER, np.int32)
        ranks[held] = self._ranks[at[held]]
        return ranks

    def apply(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words given as symbol ids end to end, and what is left of them, in the same form.

        -2 stands for a symbol without an id; it joins nothing and is left out of the result.
        """
        starts = np.cumsum(sizes) - sizes
        by_size = np.argsort(sizes, kind="stable")
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at = 0
        while at < len(by_size):
            longest = int(sizes[by_size[min(at + self.ROWS, len(by_size)) - 1]])
            some = by_size[at : at + max(1, min(self.ROWS, (self.ROWS << 6) // max(1, longest)))]
            at += len(some)
            rows, columns = _ragged(sizes[some])
            cells = np.full((len(some), int(sizes[some].max(initial=0)) + 1), -1, np.int32)
            cells[rows, columns] = flat[starts[some][rows] + columns]
            parts += self._apply(cells, some)
        counts = np.zeros(len(sizes), np.int64)
        for owner, lengths, _ in parts:
            counts[owner] = lengths
        result = np.empty(int(counts.sum()), np.int32)
        first = np.cumsum(counts) - counts
        for owner, lengths, values in parts:
            rows, columns = _ragged(lengths)
            result[first[owner][rows] + columns] = values
        return result, counts

    def _apply(self, cells: np.ndarray, owner: np.ndarray) -> Iterator[tuple]:
        width = cells.shape[1]
        if width < 2:
            yield owner, np.zeros(len(owner), np.int64), np.empty(0, np.int32)
            return
        ranks = self._rank(cells[:, :-1], cells[:, 1:])
        columns = np.arange(width)
        while len(owner):
            best = ranks.argmin(1)
            lowest = ranks[np.arange(len(owner)), best]
            going = lowest != self.NEVER
            if not going.all():
                done = cells[~going]
                yield owner[~going], (done >= 0).sum(1), done[done >= 0]
            owner, best, lowest = owner[going], best[going], lowest[going]
            cells, ranks, rows = cells[going], ranks[going], np.arange(len(owner))
            if not len(owner):
                return
            # Everything right of the joined pair moves one place to the left.
            source = np.minimum(columns + (columns > best[:, None]), width - 1)
            cells = np.take_along_axis(cells, source, 1)
            cells[:, -1] = -1
            cells[rows, best] = self._joined[lowest]
            source = np.minimum(columns[:-1] + (columns[:-1] >= best[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, source, 1)
            ranks[:, -1] = self.NEVER
            ranks[rows, best] = self._rank(cells[rows, best], cells[rows, best + 1])
            some = best > 0
            r, b = rows[some], best[some]
            ranks[r, b - 1] = self._rank(cells[r, b - 1], cells[r, b])


class Encoder:
    """Encodes UTF-8 texts to arrays of ids, as the library does without special tokens added."""

    def __init__(self, vocabulary: Vocabulary, memory: int = MEMORY) -> None:
        import ahocorasick
        from tokenizers import Tokenizer

        self.v = vocabulary
        library = Tokenizer.from_str(vocabulary.text)
        self._normal, self._pre = library.normalizer, library.pre_tokenizer
        self._memory = memory
        added = sorted(vocabulary.added, key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        self._merges = Merges(vocabulary)
        self._symbol_ids = vocabulary.symbol_ids()
        # A character per symbol, from 1 on; entries become strings of them.
        self._greedy = ahocorasick.Automaton()
        spelled = {i: vocabulary.symbols(name) for name, i in vocabulary.ids.items()}
        self._lengths = np.zeros(len(vocabulary.names), np.int64)
        self._spelled: dict[int, list[int]] = {}
        for token, symbols in spelled.items():
            if symbols is not None:
                self._greedy.add_word("".join(chr(x + 1) for x in symbols), token)
                self._lengths[token] = len(symbols)
                self._spelled[token] = symbols
        self._greedy.make_automaton()
        self._known = np.empty(0, np.int64)  # judged keys, sorted, and the judgement of each
        self._fits = np.empty(0, bool)
        self.merged = self.seen = 0
        self._forget()

    def _forget(self) -> None:
        self._pieces = pa.array([], pa.large_string())
        self._flat, self._starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    # --- from a piece of text to words ------------------------------------------------

    def _split(self, piece: str) -> list[bytes]:
        """Words of a piece, as the bytes their letters stand for."""
        if piece.isalpha() and _PLAIN.fullmatch(piece):
            return [piece.lower().encode()]
        if _PLAIN.fullmatch(piece) and "\x00" not in piece:
            return [w.encode() for w in _SPLIT.findall(piece.lower())]
        normal = self._normal.normalize_str(piece) if self._normal else piece
        byte_of = self.v.byte_of
        return [bytes([byte_of[c] for c in w]) for w, _ in self._pre.pre_tokenize_str(normal)]

    def _parts(self, piece: str) -> list[bytes | int]:
        """Words and ids of added tokens of a piece, in order."""
        if self._added is None or not self._added.search(piece):
            return self._split(piece)
        parts: list[bytes | int] = []
        at = 0
        for hit in self._added.finditer(piece):
            if hit.start() > at:
                parts += self._split(piece[at : hit.start()])
            parts.append(self.v.added[hit.group()])
            at = hit.end()
        return parts + self._split(piece[at:]) if at < len(piece) else parts

    # --- speculate, verify, merge -----------------------------------------------------

    def _stay(self, cuts: list[tuple[int, ...]]) -> np.ndarray:
        """Whether merging the letters of each cut gives the same cut."""
        places = [[x for t in cut for x in self._spelled[t]] for cut in cuts]
        sizes = np.fromiter(map(len, places), np.int64, len(places))
        flat = self._symbol_ids[np.fromiter(chain.from_iterable(places), np.int64, int(sizes.sum()))]
        merged, counts = self._merges.apply(flat, sizes)
        ends = np.cumsum(counts).tolist()
        values = merged.tolist()
        return np.fromiter(
            (tuple(values[e - n : e]) == c for e, n, c in zip(ends, counts.tolist(), cuts)), bool, len(cuts)
        )

    def _judged(self, distinct: np.ndarray) -> np.ndarray:
        """Judgement of each of the sorted ``distinct`` keys: a token alone, or a pair.

        The key of a pair is (first + 1) * size + second, that of a single token is its id.
        """
        at = np.searchsorted(self._known, distinct)
        held = at < len(self._known)
        held[held] = self._known[at[held]] == distinct[held]
        fits = np.zeros(len(distinct), bool)
        fits[held] = self._fits[at[held]]
        if not held.all():
            fresh = distinct[~held]
            size = len(self.v.names)
            cuts = [(k,) if k < size else (k // size - 1, k % size) for k in fresh.tolist()]
            fits[~held] = self._stay(cuts)
            if len(self._known) > 4 * MEMORY:
                self._known, self._fits = np.empty(0, np.int64), np.empty(0, bool)
            joined = np.concatenate([self._known, fresh])
            order = np.argsort(joined, kind="stable")
            self._known = joined[order]
            self._fits = np.concatenate([self._fits, fits[~held]])[order]
        return fits

    def _encode_words(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the (non-empty) words, given as bytes end to end, and how many each has."""
        places = words.astype(np.int64)
        if self.v.end:
            places[np.cumsum(sizes) - 1] += 256
        owner = np.repeat(np.arange(len(sizes)), sizes)
        # One pass over all words: no entry goes on after the end of a word, nor over a border
        # between words without ends, as each is then looked up on its own.
        text = (places + 1).astype("<u4").tobytes().decode("utf-32-le")
        if self.v.end:
            hits = self._greedy.iter_long(text)
        else:
            ends = np.cumsum(sizes).tolist()
            hits = (h for e, n in zip(ends, sizes.tolist()) for h in self._greedy.iter_long(text, e - n, e))
        found = np.fromiter(chain.from_iterable(hits), np.int64).reshape(-1, 2)
        last, tokens = found[:, 0], found[:, 1]
        whose = owner[last]
        lengths = self._lengths[tokens]
        # A word is proposed only if its entries cover it; where they do not, it fails.
        covered = np.bincount(whose, lengths, len(sizes))
        wrong = covered != sizes
        inside = whose[1:] == whose[:-1]
        pairs = ((tokens[:-1] + 1) * len(self.v.names) + tokens[1:])[inside]
        for keys, of in ((tokens, whose), (pairs, whose[1:][inside])):
            distinct, back = np.unique(keys, return_inverse=True)
            wrong[of[~self._judged(distinct)[back]]] = True
        self.seen += len(sizes)
        self.merged += int(wrong.sum())
        kept = ~wrong[whose]
        bad = wrong[owner]
        merged, many = self._merges.apply(self._symbol_ids[places[bad]], sizes[wrong])
        counts = np.bincount(whose[kept], minlength=len(sizes))
        counts[wrong] = many
        ids = np.concatenate([tokens[kept].astype(np.int32), merged])
        of = np.concatenate([whose[kept], np.repeat(np.flatnonzero(wrong), many)])
        return ids[np.argsort(of, kind="stable")], counts

    def _learn(self, pieces: pa.Array) -> None:
        """Encode the new ``pieces`` together."""
        parted = pc.extract_regex(pc.utf8_lower(pieces), _TWO_WORDS)
        easy = pc.and_(pc.match_substring_regex(pieces, _PLAIN_ONLY), parted.is_valid())
        if self._added is not None:
            easy = pc.and_not(easy, pc.match_substring_regex(pieces, self._added.pattern))
        parted = parted.filter(easy)
        hard = [self._parts(p) for p in pieces.filter(pc.invert(easy)).to_pylist()]
        others = list(chain.from_iterable(hard))
        added = sorted({w for w in others if w.__class__ is not bytes})
        binary = pa.large_binary()
        every = [parted.field("word").cast(binary), parted.field("mark").cast(binary)]
        every.append(pa.array([w for w in others if w.__class__ is bytes], binary))
        coded = pa.concat_arrays(every).dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        # An empty word, where a piece has no letters or no mark, has no ids.
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        counts = np.zeros(len(sizes), np.int64)
        ids, counts[sizes > 0] = self._encode_words(_bytes(words), sizes[sizes > 0])
        ids = np.concatenate([ids, np.array(added, np.int32)])
        counts = np.concatenate([counts, np.ones(len(added), np.int64)])

        plain, part = easy.to_numpy(zero_copy_only=False), len(parted)
        per_piece = np.full(len(pieces), 2, np.int64)
        per_piece[~plain] = np.fromiter(map(len, hard), np.int64, len(hard))
        first = np.cumsum(per_piece) - per_piece
        which = np.empty(int(per_piece.sum()), np.int64)
        which[first[plain]], which[first[plain] + 1] = codes[:part], codes[part : 2 * part]
        number = dict(zip(added, range(len(sizes), len(counts))))
        rest = iter(codes[2 * part :].tolist())
        rows, columns = _ragged(per_piece[~plain])
        which[first[~plain][rows] + columns] = np.fromiter(
            (next(rest) if w.__class__ is bytes else number[w] for w in others), np.int64, len(others)
        )
        flat = _gathered(ids, np.cumsum(counts) - counts, counts, which)
        sums = np.concatenate([[0], np.cumsum(counts[which])])
        lengths = sums[first + per_piece] - sums[first]
        self._pieces = pa.concat_arrays([self._pieces, pieces])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(lengths)])
        self._flat = np.concatenate([self._flat, flat])

    # --- texts ------------------------------------------------------------------------

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        array = pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())
        for flat, ends in self.encode_array(array):
            yield from np.split(flat, ends[1:-1])

    def encode_array(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the texts end to end and where each begins, for groups of a few megabytes.

        The groups are in order; the last number is where the last text of the group ends. A
        null text counts as empty.
        """
        texts = valid_texts(texts)
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            count = max(1, int(np.searchsorted(sizes, before + GROUP_BYTES, "right")) - at)
            yield self._group(texts.slice(at, count))
            at += count

    def _group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.ascii_split_whitespace(texts)
        coded = pieces.flatten().dictionary_encode()
        which = self._places(coded.dictionary)[coded.indices.to_numpy()]
        first = self._starts[which]
        sizes = self._starts[which + 1] - first
        before = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.concatenate([[0], np.cumsum(pieces.value_lengths().to_numpy())])
        return _gathered(self._flat, self._starts, sizes, which, True), before[ends]

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """The numbers of distinct pieces in the table; new ones are learned."""
        places = pc.fill_null(pc.index_in(distinct, self._pieces), -1).to_numpy().astype(np.int64)
        fresh = places < 0
        if fresh.any():
            if len(self._pieces) + int(fresh.sum()) > self._memory:
                self._forget()
                fresh[:] = True
            places[fresh] = len(self._pieces) + np.arange(int(fresh.sum()))
            self._learn(distinct.filter(pa.array(fresh)))
        return places


def _bytes(values: pa.LargeBinaryArray) -> np.ndarray:
    """The values end to end."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    if data is None or ends[0] == ends[-1]:
        return np.empty(0, np.uint8)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def valid_texts(texts: pa.Array) -> pa.Array:
    """As large strings, without nulls; bytes that are no UTF-8 become replacement characters."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    try:
        return texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())


def _gathered(
    flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray, picked: bool = False
) -> np.ndarray:
    """The rows ``which`` of ``flat``, end to end; ``sizes`` are of all rows or of those picked."""
    sizes = sizes if picked else sizes[which]
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts[which] - before, sizes) + np.arange(int(sizes.sum()))]


class Decoder:
    """Ids back to text: the names of the tokens, parted by a blank (the file names no decoder)."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._names = pa.array([n.encode() for n in vocabulary.names], pa.large_binary())

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ids given end to end, as ``encode_array`` gives them."""
        names = self._names.take(pa.array(ids))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), names), pa.scalar(b" ", pa.large_binary()))


def codec(text: str) -> tuple[Encoder, Decoder]:
    """The encoder and decoder of this worker for a vocabulary, kept between tasks."""

    def make() -> tuple[Encoder, Decoder]:
        vocabulary = Vocabulary(text)
        return Encoder(vocabulary), Decoder(vocabulary)

    return kept_in_worker(("bpe", text), make)


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file, read where the job is submitted; at most a few megabytes."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if len(text) > 64 << 20:
        raise ValueError("a vocabulary file of over 64 MB is not broadcast")
    return text


def utf8(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column of token ids, for whole texts.

    Null and empty texts give an empty list; rows and other columns stay as they are, repeated
    rows too; an empty table stays empty. A column already named as ``ids`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != ids.lower()]
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    schema = docs.select(*kept).schema.add(ids, T.ArrayType(T.IntegerType()))

    def run(batches):
        encoder, _ = codec(vocabulary.value)
        for batch in batches:
            at = 0
            for flat, ends in encoder.encode_array(batch.column(text)):
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                own = [batch.column(c).slice(at, len(column)) for c in kept]
                at += len(column)
                yield pa.RecordBatch.from_arrays([*own, column], names=[*kept, ids])

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded text.

    Encodes the whole text and decodes the ids again. Null text counts as empty (no ids, decoded
    to the empty text); a null key stays null; repeated rows give repeated rows.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        encoder, decoder = codec(vocabulary.value)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids, ends in encoder.encode_array(batch.column(1)):
                counts += np.diff(ends).tolist()
                data = memoryview(ids.astype("<u4")).cast("B")
                cuts = (4 * ends).tolist()
                of_ids += [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]
                of_text += [hashlib.sha256(t.as_buffer()).hexdigest() for t in decoder.decode(ids, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = rows.select("doc_id").schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return rows.mapInArrow(run, schema)
