"""Token files: a static range asymmetric numeral system over independent interleaved blocks.

Format (a folder of Parquet tables, each written and read by Spark):

* ``frequencies``: ``token``, ``frequency``; sums to 2**20. One shared table for all blocks.
* ``blocks``: ``start`` (ids before the block), ``n_tokens``, ``doc_ids`` and ``counts`` of
  its documents, ``lanes``, ``states`` (64-bit, one per lane), ``words`` (32-bit stream),
  ``checkpoints`` (lane states and place in the stream at every ``CHECKPOINT``-th step, so
  that parts of a block can be decoded at once), ``check`` (crc32 of states, words and
  checkpoints) and ``ids_check`` (crc32 of the ids). All numbers little-endian.

Id ``i`` of a block belongs to lane ``i % lanes``; a step handles one id of each lane.
A coder's state stays in [2**32, 2**64); words enter and leave it 32 bits at a time.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenwave.llm.common import stored, worker_memo
from greenwave.session import shared_folder

SCALE_BITS = 20
LOW = np.uint64(1 << 32)
MASK = np.uint64((1 << SCALE_BITS) - 1)
CHECKPOINT = 64
BLOCK_TOKENS = 1 << 20
#: Most lanes of a block: a step handles so many ids at once.
LANES = 8192
#: Chunks whose ids a worker remembers, half as many pieces of them and, as Arrow columns, as many pieces of
#: slices of texts. Workers stay, and so does this memory.
REMEMBERED = 450_000
#: Most bytes of a piece that is remembered in a column.
SHORT = 64
#: Bytes of text that are cut at once, and chunks (or groups of pieces) that the library encodes in one call.
SLICE_BYTES = 8 << 20
CHUNKS = 2000
GROUP = 30
CUT = re.compile(r"(?<=\S) ")
ODD = re.compile(r"\s ")
#: Fixed value: the pattern of byte-level tokenizers.
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
FAR = r"[^\x{0}-\x{24F}]"


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write visible bytes as themselves, the others as letters from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()
SPACED_LETTERS = BYTE_LETTERS | {0xFF: " "}
LETTER_CODES = np.array([ord(BYTE_LETTERS[b]) for b in range(256)], "<u4")


def _latin_kinds() -> np.ndarray:
    """Of each code point below 0x250: 0 the space, 1 other white space, 2 letter, 3 number, 4 anything else."""
    kinds = np.full(0x250, 4, np.uint8)
    for kind, pattern in ((2, r"\p{L}"), (3, r"\p{N}"), (1, r"\s"), (0, " ")):
        kinds[[ord(c) for c in regex.findall(pattern, "".join(map(chr, range(0x250))))]] = kind
    return kinds


LATIN_KINDS = _latin_kinds()


def scale(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in order and their frequencies: at least 1 each, 2**SCALE_BITS in all, two tokens or more."""
    counts = {0: 1, 1: 1} | counts if len(counts) < 2 else counts
    tokens = np.array(sorted(counts), np.int64)
    if len(tokens) > 1 << (SCALE_BITS - 1):
        raise ValueError("more distinct tokens than the frequency table holds")
    raw = np.array([counts[t] for t in tokens.tolist()], float)
    share = np.maximum(1, np.floor(raw / raw.sum() * (1 << SCALE_BITS))).astype(np.int64)
    # What rounding left over or took too much goes to and from the most frequent tokens.
    gap = (1 << SCALE_BITS) - int(share.sum())
    for k in np.lexsort((tokens, -share)).tolist():
        if gap == 0:
            break
        change = gap if gap > 0 else -min(-gap, int(share[k]) - 1)
        share[k] += change
        gap -= change
    return tokens, share


def encode(codes: np.ndarray, share: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, list]:
    """States, words and checkpoints (step, place, states) of ``codes`` (places in the table)."""
    freq = share.astype(np.uint64)
    base = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64)
    state = np.full(lanes, LOW, np.uint64)
    steps = -(-len(codes) // lanes)
    stream: list[np.ndarray] = []
    marks = []
    written = 0
    bits, word = np.uint64(SCALE_BITS), np.uint64(32)
    for step in range(steps - 1, -1, -1):
        part = codes[step * lanes : (step + 1) * lanes]
        f = freq[part]
        x = state[: len(part)]
        full = x >= f << np.uint64(64 - SCALE_BITS)
        out = x[full]
        stream.append((out & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        written += len(out)
        x[full] = out >> word
        whole = x // f
        state[: len(part)] = (whole << bits) + (x - whole * f) + base[part]
        if step and step % CHECKPOINT == 0:
            marks.append((step, written, state.copy()))
    words = np.concatenate(stream[::-1]) if stream else np.empty(0, np.uint32)
    return state, words, [(s, written - w, x) for s, w, x in marks[::-1]]


def decode(
    states: np.ndarray, words: np.ndarray, n: int, share: np.ndarray, step: int = 0, place: int = 0, last: int | None = None
) -> np.ndarray:
    """The codes from ``step`` (whose states and place in ``words`` are given) up to step ``last``."""
    lanes = len(states)
    freq = share.astype(np.uint64)
    base = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64)
    slots = np.repeat(np.arange(len(share), dtype=np.int32), share)
    state = states.copy()
    steps = -(-n // lanes) if last is None else last
    out = np.empty(max(0, min(n, steps * lanes) - step * lanes), np.int32)
    bits, word = np.uint64(SCALE_BITS), np.uint64(32)
    at = 0
    for now in range(step, steps):
        width = min(lanes, n - now * lanes)
        x = state[:width]
        slot = x & MASK
        code = slots[slot.astype(np.int64)]
        out[at : at + width] = code
        at += width
        x = freq[code] * (x >> bits) + slot - base[code]
        short = x < LOW
        taken = int(np.count_nonzero(short))
        if taken:
            x[short] = x[short] << word | words[place : place + taken]
            place += taken
        state[:width] = x
    return out


def _raw(array: pa.Array, offset: type, value: type) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of strings or bytes; columns without rows have no offsets."""
    _, offsets, values = array.buffers()
    at = np.frombuffer(offsets, offset)[array.offset : array.offset + len(array) + 1]
    return at, np.frombuffer(values, value) if values else np.zeros(0, value)


def _bodies(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes of 32-bit ``ids``, cut at ``ends`` (which begins with 0 and counts ids)."""
    at = pa.py_buffer(np.asarray(ends, np.int64) * 4)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, at, pa.py_buffer(ids)])


def _cut(chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``PIECE``'s pieces of Latin chunks, each read behind a space, and how many belong to each chunk.

    No chunk is empty, holds a space or ends in white space. A piece ends where the kind of character changes,
    except in chunks with apostrophes or adjacent white space, which the pattern itself cuts.
    """
    at, values = _raw(chunks, np.int32, np.uint8)
    text = np.insert(values[at[0] : at[-1]], at[:-1] - at[0], 32)
    kind = LATIN_KINDS[text]
    lead = np.flatnonzero(text >= 0xC0)
    kind[lead] = kind[lead + 1] = LATIN_KINDS[(text[lead].astype(np.int64) & 31) << 6 | text[lead + 1] & 63]
    before = kind[:-1]
    starts = np.flatnonzero(np.concatenate([[True], (kind[1:] != before) & (before != 0)]))
    pieces = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(text)).astype(np.int32)), pa.py_buffer(text)
    )
    begins = np.flatnonzero(text[starts] == 32)
    n = np.diff(begins, append=len(starts))
    wide = (kind[1:] == 1) & (before <= 1) & (text[1:] & 0xC0 != 0x80)
    knots = np.flatnonzero((text == 39) | np.concatenate([[False], wide]))
    if not len(knots):
        return pieces, n
    knotty = np.zeros(len(chunks), bool)
    knotty[np.searchsorted(starts[begins], knots, side="right") - 1] = True
    found = PIECE.findall(" " + " ".join(chunks.filter(pa.array(knotty)).to_pylist()))
    # A piece that begins with a space begins a chunk; another space of a chunk ends a run of white space.
    where = np.flatnonzero([p[0] == " " for p in found])
    plain = np.repeat(~knotty, n)
    # Pieces in the order of their chunks.
    n[knotty] = np.diff(where, append=len(found))
    both = pa.concat_arrays([pieces.filter(pa.array(plain)), pa.array(found, pa.string())])
    order = np.empty(len(both), np.int64)
    late = np.repeat(knotty, n)
    order[~late] = np.arange(int(plain.sum()))
    order[late] = np.arange(int(plain.sum()), len(both))
    return both.take(pa.array(order)), n


class PieceMemory:
    """A byte-level tokenizer that looks up the ids of pieces it has met.

    A byte-level tokenizer never joins characters across a space that follows a character
    that is no space, so texts are cut there, and an unknown chunk is cut by the tokenizer's
    own pattern into the pieces that the library's model then encodes, each once. The first
    ``remembered`` chunks, first chunks and pieces stay in memory; those that come later, which are the
    rarer ones, are encoded anew, and so are long pieces of slices. Chunks beyond Latin letters and
    texts that hold an added token go to the library whole, and so does every text if the tokenizer
    is of another kind.

    ``encode_all`` encodes many texts: each distinct chunk of a slice is cut once, and the library reads each
    new piece of a slice once. Pieces stand between bytes that no text holds and no merge joins; what belongs
    to a chunk that the library reads whole is told by the lengths of the tokens in bytes.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        self.tool = Tokenizer.from_file(path)
        kind = json.loads(self.tool.to_str())
        first = kind["pre_tokenizer"] or {}
        self.plain = (
            kind["normalizer"] is None
            and kind["model"]["type"] == "BPE"
            and first.get("type") == "ByteLevel"
            and first.get("use_regex", True)
            and not first.get("add_prefix_space", True)
        )
        self.added = [t.content for t in self.tool.get_added_tokens_decoder().values()]
        vocabulary = self.tool.get_vocab()
        model = kind["model"]
        alike = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        joint = self.plain and not any(map(model.get, alike))
        joint = joint and not any(BYTE_LETTERS[0xFF] in t for t in vocabulary.keys() - {BYTE_LETTERS[0xFF], *self.added})
        #: Bytes of each token; none if pieces and chunks cannot be told apart once joined.
        self.lengths = np.zeros(0, np.int64)
        if joint and not any(" " in t for t in self.added) and vocabulary.keys() >= set(BYTE_LETTERS.values()):
            self.between = vocabulary[BYTE_LETTERS[0xFF]]
            self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.lengths[list(vocabulary.values())] = list(map(len, vocabulary))
        self.model = Tokenizer(self.tool.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.bare = Tokenizer(self.tool.model)
        self.remembered = remembered
        self.heads: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.known = pa.array([], pa.string())
        self.known_ids = pa.array([], pa.large_binary())

    def whole(self, text: str) -> bytes:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of ``text`` as the library's ``encode(text, add_special_tokens=False)`` gives them."""
        text = text or ""
        if not self.plain or any(t in text for t in self.added):
            return np.frombuffer(self.whole(text), np.uint32)
        odd = ODD.search(text) is not None
        first, *rest = CUT.split(text) if odd else text.split(" ")
        body = list(map(self.chunks.get, rest))  # known ids are never empty
        if not all(body):
            missing = [k for k, ids in enumerate(body) if not ids]
            # Chunks are joined in any order: none may end in space, which only a text's last one can.
            found = self._chunks({rest[k] for k in missing}, " ", not odd and not text[-1].isspace())
            if len(self.chunks) + len(found) <= self.remembered:
                self.chunks.update(found)
            for k in missing:
                body[k] = found[rest[k]]
        head = self.heads.get(first)
        if head is None:
            head = self._chunks({first}, "", False)[first]
            if len(self.heads) < self.remembered // 4:
                self.heads[first] = head
        return np.frombuffer(b"".join([head, *body]), np.uint32)

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """``encode`` of each of ``texts``, slice by slice."""
        size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(texts):
            return
        starts = np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES, prepend=-1)).tolist()
        for low, high in zip(starts, [*starts[1:], len(texts)], strict=True):
            yield from self._slice(pc.fill_null(texts.slice(low, high - low), ""))
            pa.default_memory_pool().release_unused()  # other workers need it

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        first, last = at[:-1] - at[0], at[1:] - at[0] - 1
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        chunks = coded.dictionary
        # White space before a space, or a space at the start: such texts are cut elsewhere.
        final = pc.utf8_slice_codeunits(chunks, -1)
        loose = pc.or_(pc.equal(final, ""), pc.utf8_is_space(final)).to_numpy(zero_copy_only=False)
        inner = loose[code]
        inner[last] = False
        alone = np.logical_or.reduceat(inner, first)
        for content in self.added:
            alone |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        alone |= not len(self.lengths)
        # A chunk is read behind a space, the first of a text is not; one that ends in space is a text's last.
        here = np.repeat(~alone, last - first + 1)
        body = here.copy()
        body[first] = False
        used = np.zeros(len(chunks), bool)
        used[code[body]] = True
        heads, code[first] = np.unique(code[first], return_inverse=True)
        code[first] += len(chunks)
        tidy, ends = np.flatnonzero(used & ~loose), np.flatnonzero(used & loose)
        singles = chunks.take(pa.array(ends)).to_pylist(), chunks.take(pa.array(heads)).to_pylist()
        found = [self._chunks(set(part), before, False) for part, before in zip(singles, (" ", ""), strict=True)]
        rest = [ids[c] for part, ids in zip(singles, found, strict=True) for c in part]
        # The last body, without ids, stands for the chunks of texts that are encoded alone.
        bodies = pa.concat_arrays([self._tidy(chunks.take(pa.array(tidy))), pa.array([*rest, b""], pa.large_binary())])
        place = np.full(len(chunks) + len(heads), len(bodies) - 1)
        place[tidy] = np.arange(len(tidy))
        place[ends] = len(tidy) + np.arange(len(ends))
        place[len(chunks) :] = len(tidy) + len(ends) + np.arange(len(heads))
        at, out = _raw(bodies.take(pa.array(np.where(here, place[code], len(bodies) - 1))), np.int64, np.uint32)
        for k, (low, high) in enumerate(zip((at[first] // 4).tolist(), (at[last + 1] // 4).tolist(), strict=True)):
            yield self.encode(texts[k].as_py()) if alone[k] else out[low:high]

    def _tidy(self, chunks: pa.Array) -> pa.Array:
        """Bytes of the ids of chunks, each read behind a space; none is empty or ends in white space."""
        far = pc.match_substring_regex(chunks, FAR).to_numpy(zero_copy_only=False)
        latin = chunks.filter(pa.array(~far))
        parts = []
        if len(latin):
            pieces, n = _cut(latin)
            at, ids = _raw(self._piece_ids(pieces), np.int64, np.uint32)
            parts.append(_bodies(ids, at[np.concatenate([[0], np.cumsum(n)])] // 4))
        beyond = [f" {c}" for c in chunks.filter(pa.array(far)).to_pylist()]
        for low in range(0, len(beyond), CHUNKS):
            ids, n = self._joined(beyond[low : low + CHUNKS])
            parts.append(_bodies(ids, np.concatenate([[0], np.cumsum(n)])))
        if len(parts) < 2:
            return parts[0] if parts else pa.array([], pa.large_binary())
        place = np.empty(len(chunks), np.int64)
        place[~far] = np.arange(len(latin))
        place[far] = np.arange(len(latin), len(chunks))
        return pa.concat_arrays(parts).take(pa.array(place))

    def _piece_ids(self, pieces: pa.Array) -> pa.Array:
        """Bytes of the ids of each piece."""
        coded = pieces.dictionary_encode()
        places = pc.index_in(coded.dictionary, value_set=self.known)
        fresh = coded.dictionary.filter(places.is_null())
        fresh_ids = self._encoded(fresh)
        new = places.is_null().to_numpy(zero_copy_only=False)
        at = places.fill_null(0).to_numpy().astype(np.int64)
        at[new] = len(self.known) + np.arange(len(fresh))
        ids = pa.concat_arrays([self.known_ids, fresh_ids])
        short = pc.binary_length(fresh).to_numpy() <= SHORT
        kept = pa.array(short & (np.cumsum(short) <= self.remembered - len(self.known)))
        if kept.true_count:
            self.known = pa.concat_arrays([self.known, fresh.filter(kept)])
            self.known_ids = pa.concat_arrays([self.known_ids, fresh_ids.filter(kept)])
        return ids.take(pa.array(at[coded.indices.to_numpy()]))

    def _encoded(self, pieces: pa.Array) -> pa.Array:
        """Bytes of the ids that the library's model gives for each of ``pieces``."""
        if not len(pieces):
            return pa.array([], pa.large_binary())
        # 0xFF is no byte of UTF-8: it stands behind each piece.
        at, raw = _raw(pieces, np.int32, np.uint8)
        letters = LETTER_CODES[np.insert(raw[at[0] : at[-1]], at[1:] - at[0], 0xFF)].tobytes().decode("utf-32-le")
        ends = at - at[0] + np.arange(len(at))
        marks = [*ends[:-1:GROUP].tolist(), len(letters)]
        groups = [letters[a:b] for a, b in zip(marks, marks[1:])]
        found = []
        for low in range(0, len(groups), CHUNKS):
            for got in self.bare.encode_batch_fast(groups[low : low + CHUNKS], add_special_tokens=False):
                found.append(np.array(got.ids, np.uint32))
        ids = np.concatenate(found)
        between = np.flatnonzero(ids == self.between)
        if len(between) != len(pieces):
            raise ValueError("pieces cannot be told apart")
        return _bodies(np.delete(ids, between), np.concatenate([[0], between - np.arange(len(pieces))]))

    def _joined(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``parts``, which the tokenizer does not join, and how many belong to each."""
        ids = np.array(self.tool.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(p.encode()) for p in parts]), side="right")
        return ids, np.diff(ends, prepend=0)

    def _chunks(self, chunks: set[str], before: str, one_space: bool) -> dict[str, bytes]:
        """Ids of chunks, each read behind ``before``.

        With ``one_space`` no chunk holds a space or ends in white space, so that all are cut into pieces
        at once: a piece that begins with a space begins a chunk.
        """
        out = {c: self.whole(before + c) for c in chunks if not c.isascii() and max(c) >= "\u0250"}
        plain = [c for c in chunks if c not in out]
        if one_space and before == " ":
            pieces = PIECE.findall(" " + " ".join(plain)) if plain else []
            starts = [k for k, p in enumerate(pieces) if p[0] == " "]
            cut = [pieces[a:b] for a, b in zip(starts, [*starts[1:], len(pieces)])]
        else:
            cut = [PIECE.findall(before + c) for c in plain]
        known, fresh = self.pieces, {}
        missing = [p for p in {p for pieces in cut for p in pieces} if p not in known]
        if missing:
            # 0xFF is no byte of UTF-8: it stands between pieces.
            joined = b"\xff".join(map(str.encode, missing)).decode("latin-1").translate(SPACED_LETTERS)
            got = self.model.encode(joined, add_special_tokens=False)
            ids, at = np.array(got.ids, np.uint32), np.array(got.word_ids)
            ends = (4 * np.searchsorted(at, np.arange(len(missing)), side="right")).tolist()
            raw = ids.tobytes()
            fresh = {p: raw[a:b] for p, a, b in zip(missing, [0, *ends], ends)}
            if len(known) + len(fresh) <= self.remembered // 2:
                known.update(fresh)
        if not fresh or missing[0] in known:
            out.update((c, b"".join(map(known.__getitem__, pieces))) for c, pieces in zip(plain, cut))
        else:
            out.update(
                (c, b"".join([known.get(p) or fresh[p] for p in pieces])) for c, pieces in zip(plain, cut)
            )
        return out


def _tokenizer(path: str) -> PieceMemory:
    memo = worker_memo("tokenizers")
    if path not in memo:
        memo[path] = PieceMemory(path)
    return memo[path]


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Blocks of ids in ascending ``doc_id`` order, nulls first: the ordered parts of the file.

    ``part`` (rising with ``doc_id``), ``first`` (ids before the block in its part),
    ``doc_ids``, ``counts``, ``ids``. A block ends with a document. Rows are dealt by ranges of
    (``doc_id``, hash of the text); equal ids stand side by side.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _tokenizer(tokenizer_path)
        part, first = TaskContext.get().partitionId(), 0
        held: list[np.ndarray] = []
        names: list = []
        counts: list[int] = []
        size = 0
        end = np.array([end_id], np.uint32)

        def block() -> pa.RecordBatch:
            ids = np.concatenate(held)
            small = ids.astype(np.uint16) if ids.max() < 1 << 16 else ids
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "first": pa.array([first], pa.int64()),
                    "doc_ids": pa.array([names], pa.list_(id_type)),
                    "counts": pa.array([counts], pa.list_(pa.int64())),
                    "wide": pa.array([small.itemsize == 4]),
                    "ids": pa.array([small.tobytes()], pa.binary()),
                }
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            found = tool.encode_all(batch.column("text"))
            for name, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                held += (ids, end)
                counts.append(len(ids) + 1)
                names.append(name)
                size += len(ids) + 1
                if size >= BLOCK_TOKENS:
                    yield block()
                    first += size
                    held, names, counts, size = [], [], [], 0
        if held:
            yield block()

    keys = ["doc_id", F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = f"part int, first long, doc_ids array<{kind}>, counts array<long>, wide boolean, ids binary"
    return dealt.mapInArrow(run, schema)


def _ids(wide: bool, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint32 if wide else np.uint16).astype(np.int64)


def _count(blocks: DataFrame) -> dict[int, int]:
    """Occurrences of each token over all blocks; each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for wide, raw in zip(batch.column("wide").to_pylist(), batch.column("ids"), strict=True):
                found = np.bincount(_ids(wide, raw.as_py()))
                if len(found) > len(total):
                    total, found = found, total
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": pa.array(seen), "times": pa.array(total[seen])})

    counted = blocks.select("wide", "ids").mapInArrow(run, "token long, times long")
    rows = counted.groupBy("token").agg(F.sum("times").alias("times")).collect()
    return {r["token"]: r["times"] for r in rows}


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Encode all of ``docs`` (``doc_id``, ``text``) with one frequency table and write the file.

    Null texts are empty. Other columns are ignored; an empty frame gives empty tables. The
    ids stay in the shared folder between the passes (tokenise, count, encode). The driver
    receives one count per token of the vocabulary and one per part.
    """
    spark = docs.sparkSession
    blocks = stored(token_blocks(docs, tokenizer_path, end_id), "token-blocks", compression="zstd")
    tokens, share = scale(_count(blocks))
    spark.createDataFrame(
        [(int(t), int(f)) for t, f in zip(tokens, share, strict=True)], "token long, frequency long"
    ).write.parquet(f"{path}/frequencies")
    sums = blocks.select("part", F.expr("aggregate(counts, 0L, (a, c) -> a + c)").alias("n"))
    offsets, before = {}, 0
    for r in sums.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        offsets[r["part"]], before = before, before + r["n"]
    place = np.zeros(int(tokens[-1]) + 1, np.int32)
    place[tokens] = np.arange(len(tokens), dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("part", "first", "counts", "wide", "ids")}
                ids = _ids(row["wide"], row["ids"])
                lanes = max(1, min(LANES, len(ids) // 64))
                states, words, marks = encode(place[ids], share, lanes)
                steps = np.array([m[0] for m in marks], np.int64)
                places = np.array([m[1] for m in marks], np.int64)
                saved = b"".join(m[2].tobytes() for m in marks)
                body = states.tobytes() + words.tobytes() + steps.tobytes() + places.tobytes() + saved
                yield pa.RecordBatch.from_pydict(
                    {
                        "start": pa.array([offsets[row["part"]] + row["first"]], pa.int64()),
                        "n_tokens": pa.array([len(ids)], pa.int64()),
                        "doc_ids": batch.column("doc_ids").slice(k, 1),
                        "counts": batch.column("counts").slice(k, 1),
                        "lanes": pa.array([lanes], pa.int32()),
                        "states": pa.array([states.tobytes()], pa.binary()),
                        "words": pa.array([words.tobytes()], pa.binary()),
                        "checkpoint_steps": pa.array([steps.tolist()], pa.list_(pa.int64())),
                        "checkpoint_places": pa.array([places.tolist()], pa.list_(pa.int64())),
                        "checkpoint_states": pa.array([saved], pa.binary()),
                        "check": pa.array([zlib.crc32(body)], pa.int64()),
                        "ids_check": pa.array([zlib.crc32(ids.astype(np.uint32).tobytes())], pa.int64()),
                    }
                )

    kind = blocks.schema["doc_ids"].dataType.simpleString()
    schema = (
        f"start long, n_tokens long, doc_ids {kind}, counts array<long>, lanes int, states binary, words binary, "
        "checkpoint_steps array<long>, checkpoint_places array<long>, checkpoint_states binary, check long, ids_check long"
    )
    blocks.mapInArrow(run, schema).write.parquet(f"{path}/blocks")


def block_codes(row: dict, share: np.ndarray) -> np.ndarray:
    """The codes of a block, decoded stretch by stretch from its checkpoints; checks the bytes."""
    steps = np.array(row["checkpoint_steps"], np.int64)
    places = np.array(row["checkpoint_places"], np.int64)
    body = row["states"] + row["words"] + steps.tobytes() + places.tobytes() + row["checkpoint_states"]
    if zlib.crc32(body) != row["check"]:
        raise ValueError(f"block at {row['start']} is damaged")
    lanes, n = row["lanes"], row["n_tokens"]
    states = np.frombuffer(row["states"] + row["checkpoint_states"], np.uint64).reshape(-1, lanes)
    words = np.frombuffer(row["words"], np.uint32)
    starts = [0, *steps.tolist()]
    ends = [*steps.tolist(), -(-n // lanes)]
    at = [0, *places.tolist()]
    parts = [
        decode(states[k], words, n, share, starts[k], at[k], ends[k]) for k in range(len(starts))
    ]
    return np.concatenate(parts)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian 32-bit) of each document."""
    blocks = spark.read.parquet(f"{path}/blocks")
    table = spark.read.parquet(f"{path}/frequencies").orderBy("token").collect()
    tokens = np.array([r["token"] for r in table], np.uint32)
    share = np.array([r["frequency"] for r in table], np.int64)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "doc_ids"}
                ids = tokens[block_codes(row, share)]
                if zlib.crc32(ids.tobytes()) != row["ids_check"]:
                    raise ValueError(f"block at {row['start']} decodes to other ids")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                names = batch.column("doc_ids")[k].values
                for low in range(0, len(counts), 1000):  # bounds a batch's size
                    high = min(low + 1000, len(counts))
                    pieces = [ids[ends[j] - counts[j] : ends[j]].tobytes() for j in range(low, high)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": names.slice(low, high - low),
                            "start": pa.array(row["start"] + ends[low:high] - counts[low:high]),
                            "n_tokens": pa.array(counts[low:high]),
                            "ids": pa.array(pieces, pa.binary()),
                        }
                    )

    return blocks.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and digest what is read back."""
    path = shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_files(docs.sparkSession, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
