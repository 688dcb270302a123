"""Byte-level pre-tokenizer as a finite-state transducer, and BPE by one.

Two transducers, both deterministic:

* The splitter reads the bytes of UTF-8 texts by class and says before which
  bytes a piece begins.  What the published pattern looks ahead at (the letters
  of a contraction, the end of a run of white space) is folded into the symbols,
  so that its transitions have no delay.  The bytes are cut into equal chunks;
  all chunks advance together from every start state, which gives a state map
  per chunk; a parallel prefix scan composes the maps, and the known start
  states then give the emissions of all chunks at once.
* ``BpeTransducer`` reads the bytes of one piece; each transition is annotated
  with the (signed) number of tokens that it adds.  A state holds, for each
  suffix that may still become part of a token, its trie node, the last token
  before it and the relative token count.  States and transitions are compiled
  when first met and kept in a cache of bounded size.

``begins_by_rule`` is the splitter's function written as a comparison of
neighbours, for callers that only need pieces.
"""

from __future__ import annotations

import base64
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# ------------------------------------------------------------- classes ----

# symbols of the splitter's alphabet: the same again, plus _FIRST, at the start of a text
LETTER, DIGIT, OTHER, SHORT, LONG, SP_LAST, WS_LAST, WS_MID = range(8)
_FIRST, INNER = 8, 16  # INNER: a later byte of a code point
_STATES = 8
# classes before look-ahead
_L, _N, _S, _O, _SPACE, _QUOTE, _END = range(7)
_CODES = 0x110000
_CHUNK = 192


@lru_cache(4)
def _classes(path: str) -> np.ndarray:
    """Class of each code point.

    Libraries carry different versions of Unicode.  Where the two tables at
    hand disagree, the library that reads the vocabulary at ``path`` is asked.
    """
    table = np.full(_CODES, _O, np.uint8)
    newer = table.copy()
    every = "".join(map(chr, (i for i in range(_CODES) if not 0xD800 <= i < 0xE000)))
    for pattern, kind in ((r"\p{L}+", _L), (r"\p{N}+", _N)):
        for m in regex.finditer(pattern, every):
            newer[[ord(c) for c in m[0]]] = kind
    for c in every:
        group = unicodedata.category(c)[0]
        if group in "LN":
            table[ord(c)] = _L if group == "L" else _N
    unsure = np.flatnonzero(table != newer)
    for point, ends in zip(unsure, _contracts(path, [chr(i) for i in unsure])):
        known = table[point] if table[point] != _O else newer[point]
        table[point] = known if ends else _O
    # Unicode White_Space: fixed values
    table[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _S
    table[32], table[39] = _SPACE, _QUOTE
    return table


def _contracts(path: str, signs: list[str]) -> list[bool]:
    """Whether the library reads 's after each sign as a contraction: only after letters and digits."""
    probes = [c + "'s" for c in signs]
    if path.endswith(".tiktoken"):
        import tiktoken
        from public_tokenizers import PATTERN

        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_vocabulary(path).ids, special_tokens={})
        return [own.decode_single_token_bytes(own.encode_ordinary(p)[-1]) == b"'s" for p in probes]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    return [own.pre_tokenizer.pre_tokenize_str(p)[-1][0] == "'s" for p in probes]


@lru_cache(1)
def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, begins a piece) by [symbol, state]; state 0 is the start."""
    start, letters, digits, others, prefix, white, one, two = range(_STATES)
    step = np.zeros((INNER + 1, _STATES), np.uint8)
    begin = np.ones((INNER + 1, _STATES), np.uint8)
    step[LETTER], step[DIGIT], step[OTHER], step[SHORT], step[LONG] = letters, digits, others, one, two
    step[SP_LAST], step[WS_LAST], step[WS_MID] = prefix, start, white
    step[_FIRST:INNER] = step[:_FIRST, :1]

    def goes_on(symbol: int, state: int, to: int) -> None:
        step[symbol, state], begin[symbol, state] = to, 0

    goes_on(LETTER, letters, letters)
    goes_on(DIGIT, digits, digits)
    goes_on(WS_MID, white, white)
    for symbol in (OTHER, SHORT, LONG):  # an apostrophe inside a run of signs is one of them
        goes_on(symbol, others, others)
        goes_on(symbol, prefix, others)
    goes_on(LETTER, prefix, letters)
    goes_on(DIGIT, prefix, digits)
    goes_on(LETTER, one, start)
    goes_on(LETTER, two, one)
    step[INNER], begin[INNER] = np.arange(_STATES), 0
    return step, begin


# contractions of the pattern: fixed values
_ENDS_ONE = frozenset(b"stmd")
_ENDS_TWO = frozenset((b"re", b"ve", b"ll"))


def _symbols(data: np.ndarray, starts: np.ndarray, path: str) -> np.ndarray:
    """Symbol of each byte; texts begin at ``starts`` (ascending, the first is 0)."""
    classes = _classes(path)
    kinds = np.append(classes[:128], np.full(128, _O, np.uint8))[data]
    wide = np.flatnonzero(data >= 0xC0)
    inner = (data & 0xC0) == 0x80
    if len(wide):
        lead = data[wide].astype(np.int64)
        after = np.append(data, np.zeros(3, np.uint8))
        b1, b2, b3 = (after[wide + i].astype(np.int64) & 63 for i in (1, 2, 3))
        code = np.where(
            lead < 0xE0,
            (lead & 31) << 6 | b1,
            np.where(lead < 0xF0, (lead & 15) << 12 | b1 << 6 | b2, (lead & 7) << 18 | b1 << 12 | b2 << 6 | b3),
        )
        kinds[wide] = classes[code]
        for i in (1, 2, 3):  # later bytes carry the class of their code point
            at = wide[lead >= (0xC0, 0xE0, 0xF0)[i - 1]] + i
            kinds[at] = kinds[at - i]
    symbols = np.array([LETTER, DIGIT, WS_MID, OTHER, WS_MID, OTHER], np.uint8)[kinds]
    white = (kinds == _SPACE) | (kinds == _S)
    after = np.empty(len(data), bool)  # white space or the end follows
    after[:-1] = white[1:]
    after[-1] = True
    after[starts[1:] - 1] = True
    # the last white space before something else; of a wide one, the look-ahead is at its last byte
    last = white & ~after
    symbols[last & (kinds == _SPACE)] = SP_LAST
    tail = np.flatnonzero(last & (kinds == _S))
    while len(tail):
        symbols[tail] = WS_LAST
        tail = tail[inner[tail]] - 1
    raw = data.tobytes()
    edges = set(starts.tolist()) if (kinds == _QUOTE).any() else ()
    for q in np.flatnonzero(kinds == _QUOTE).tolist():
        if q + 1 < len(raw) and raw[q + 1] in _ENDS_ONE and q + 1 not in edges:
            symbols[q] = SHORT
        elif raw[q + 1 : q + 3] in _ENDS_TWO and q + 1 not in edges and q + 2 not in edges:
            symbols[q] = LONG
    symbols[inner] = INNER
    symbols[starts] += _FIRST
    return symbols


def begins_by_transducer(symbols: np.ndarray) -> np.ndarray:
    """Where a piece begins, by chunk state maps and their prefix scan."""
    step, begin = (x.ravel() for x in _transitions())
    n = len(symbols)
    chunks = max(1, -(-n // _CHUNK))
    grid = np.full(chunks * _CHUNK, INNER, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(chunks, _CHUNK).T) * np.uint8(_STATES)
    maps = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], chunks, 1)
    for row in grid:  # all chunks, all start states
        maps = step[row + maps]
    # inclusive prefix scan of the composition, log2(chunks) rounds
    gap = 1
    while gap < chunks:
        maps = np.concatenate([maps[:, :gap], np.take_along_axis(maps[:, gap:], maps[:, :-gap].astype(np.intp), 0)], 1)
        gap *= 2
    state = np.append(np.zeros(1, np.uint8), maps[0, :-1])
    out = np.empty(grid.shape, np.uint8)
    for i, row in enumerate(grid):
        at = row + state
        out[i] = begin[at]
        state = step[at]
    return out.T.reshape(-1)[:n].astype(bool)


def begins_by_rule(symbols: np.ndarray) -> np.ndarray:
    """The same by comparing neighbours, for texts as they are: faster, without states.

    A piece begins where the kind of symbol changes, but not after a space that
    joins what follows; contractions, which are rare, are then put right one by one.
    """
    inner = symbols == INNER
    first = (symbols >= _FIRST) & ~inner
    plain = np.where(first, symbols - np.uint8(_FIRST), symbols)
    group = np.array([0, 1, 2, 2, 2, 3, 4, 5], np.uint8)  # letter, digit, sign, joining space, ...
    lead = np.flatnonzero(~inner)
    kind, at_start = group[plain[lead]], first[lead]
    begin = np.ones(len(lead), bool)
    same = kind[1:] == kind[:-1]
    begin[1:] = ~((same & (kind[1:] != 3) & (kind[1:] != 4)) | (kind[:-1] == 3)) | at_start[1:]
    signs = plain[lead]
    for q in np.flatnonzero(begin & ((signs == SHORT) | (signs == LONG))).tolist():
        end = q + (2 if signs[q] == SHORT else 3)
        begin[q + 1 : end] = False
        if end < len(begin):
            begin[end] = True
            # an apostrophe right after a contraction begins a piece, and so is met later in this loop
    out = np.zeros(len(symbols), bool)
    out[lead] = begin
    return out


# ------------------------------------------------------------ the split ----


SLICE_BYTES = 8 << 20


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the texts of a string array."""
    texts = texts.cast(pa.large_string())
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]


def text_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most ``most`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    ends = text_offsets(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Pieces:
    """Pieces of a batch of texts: ``index`` into ``distinct``; text i has ``docs[i]:docs[i + 1]``."""

    def __init__(self, index: np.ndarray, distinct: list[bytes], docs: np.ndarray):
        self.index, self.distinct, self.docs = index, distinct, docs

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum over each text of a value per distinct piece."""
        return np.diff(np.append(0, np.cumsum(values[self.index]))[self.docs])


def split_texts(texts: pa.Array, path: str, specials: tuple[str, ...] = (), begins=begins_by_rule) -> Pieces:
    """Split each text (string array, null is empty) into the pieces of the pattern.

    ``path`` names the vocabulary whose library's Unicode classes hold;
    ``specials`` are strings that are pieces of their own wherever they stand.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = text_offsets(texts)
    raw = texts.buffers()[2]
    raw = b"" if raw is None else raw.to_pybytes()[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not raw:
        return Pieces(np.zeros(0, np.int64), [], np.zeros(len(texts) + 1, np.int64))
    data = np.frombuffer(raw, np.uint8)
    starts = offsets[:-1][np.diff(offsets) > 0]
    found = _special_spans(raw, starts, specials)
    if found:
        edges = np.array([x for span in found for x in span])
        starts = np.unique(np.append(starts, edges[edges < len(raw)]))
    begin = begins(_symbols(data, starts, path))
    for a, b in found:
        begin[a + 1 : b] = False
    at = np.flatnonzero(begin)
    ends = pa.py_buffer(np.append(at, len(raw)).astype(np.int64))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, ends, pa.py_buffer(raw)])
    coded = pc.dictionary_encode(pieces)
    return Pieces(coded.indices.to_numpy(), coded.dictionary.to_pylist(), np.searchsorted(at, offsets))


def _special_spans(raw: bytes, starts: np.ndarray, specials: tuple[str, ...]) -> list[tuple[int, int]]:
    """Leftmost spans of the special strings, none across two texts."""
    strings = [s.encode() for s in specials if s.encode() in raw]
    if not strings:
        return []
    edges, spans = starts[1:], []
    for m in regex.finditer(b"|".join(map(regex.escape, sorted(strings, key=len, reverse=True))), raw):
        a, b = m.span()
        cut = np.searchsorted(edges, a, "right")
        if cut == len(edges) or edges[cut] >= b:
            spans.append((a, b))
    return spans


# ------------------------------------------------------------ vocabulary ----


class Vocabulary:
    """Byte-level BPE vocabulary: bytes of each id, rank of each mergeable string.

    ``by_pairs`` tells merges stated as pairs (.json) from merges stated by the
    rank of the joined bytes (.tiktoken).
    """

    def __init__(self, ids: dict[bytes, int], ranks: dict, by_pairs: bool, specials: dict[str, int]):
        self.ids, self.ranks, self.by_pairs, self.specials = ids, ranks, by_pairs, specials

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece: the lowest-ranked adjacent pair is merged, the leftmost first."""
        if not self.by_pairs and piece in self.ids:
            return [self.ids[piece]]
        if len(piece) > 64:
            return self._encode_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks, by_pairs, none = self.ranks, self.by_pairs, 1 << 60
        found = [ranks.get((a, b) if by_pairs else a + b, none) for a, b in zip(parts, parts[1:])]
        while found:
            low = min(found)
            if low == none:
                break
            i = found.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            for j in (i - 1, i):
                if 0 <= j < len(found):
                    a, b = parts[j], parts[j + 1]
                    found[j] = ranks.get((a, b) if by_pairs else a + b, none)
        return [self.ids[p] for p in parts]

    def _encode_long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list, for pieces of any length."""
        import heapq

        n = len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n:
                a, b = parts[i], parts[j]
                rank = self.ranks.get((a, b) if self.by_pairs else a + b)
                if rank is not None:
                    heapq.heappush(heap, (rank, i, a, b))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if j >= n or parts[i] != a or parts[j] != b:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        return [self.ids[p] for p in parts if p is not None]


def byte_letters() -> dict[str, int]:
    """The printable stand-in letter of each byte in .json vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(4)
def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level .json (tokenizers) or .tiktoken vocabulary; the file may be on any path Python can open."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return Vocabulary(ranks, ranks, False, {})
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec["pre_tokenizer"], spec["model"]
    plain = pre["type"] == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
    if not plain or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("only plain byte-level BPE files are understood")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that strip or match words are not understood")
    letters = byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ids = {raw(k): v for k, v in model["vocab"].items() if k not in specials}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
    return Vocabulary(ids, ranks, True, specials)


# -------------------------------------------------------- the transducer ----


class BpeTransducer:
    """Token counts of pieces by a deterministic transducer, compiled on demand.

    BPE of a prefix without its last token is BPE of the shorter prefix, and a
    token may follow another exactly if the two come out of merging their
    joined bytes.  So the last token of each prefix is found among the tokens
    that end there, and the count is one more than that of the prefix before.
    """

    MAX_STATES = 150_000

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.bytes_of = {v: k for k, v in vocabulary.ids.items()}
        for piece, token in vocabulary.ids.items():
            node = 0
            for b in piece:
                to = self.trie[node].get(b)
                if to is None:
                    to = self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = to
            self.token[node] = token
        # how each token is made: rank, left part, right part; bytes are there from the start
        self.made: dict[int, tuple[int, int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        ids = vocabulary.ids
        for (left, right), rank in vocabulary.ranks.items():
            self.made[ids[left + right]] = (rank, ids[left], ids[right])
            self.rank[ids[left], ids[right]] = rank
        self.alone: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.entries: list[tuple] = []
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.pairs.clear()
        self.start = self._state(((0, -1, 0),))

    def _state(self, entries: tuple) -> int:
        found = self.states.get(entries)
        if found is None:
            found = self.states[entries] = len(self.entries)
            self.entries.append(entries)
            self.moves.append({})
        return found

    def _stands(self, token: int) -> bool:
        """Do the bytes of the token merge into it?"""
        found = self.alone.get(token)
        if found is None:
            found = self.alone[token] = self.vocabulary.encode(self.bytes_of[token]) == [token]
        return found

    def _follows(self, last: int, token: int) -> bool:
        """May ``token`` stand right after ``last`` (-1: at the start of a piece)?

        Goes back in time through the parts of both that touch; a merge across
        the border took place if it ranks before the merges that took up its
        two sides (the left one of equals goes first).
        """
        if last < 0 or not self._stands(token):
            return self._stands(token)
        found = self.pairs.get((last, token))
        if found is not None:
            return found
        a, b, end = last, token, 1 << 60
        a_taken = b_taken = end
        never, made, rank = (-1, 0, 0), self.made, self.rank
        found = True
        while True:
            across = rank.get((a, b), end)
            if across < a_taken and across <= b_taken and across != end:
                found = False
                break
            a_made, b_made = made.get(a, never), made.get(b, never)
            if a_made[0] > b_made[0]:
                a_taken, a = a_made[0], a_made[2]
            elif b_made[0] >= 0:
                b_taken, b = b_made[0], b_made[1]
            else:
                break
        self.pairs[last, token] = found
        return found

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """Transition: (next state, tokens added). Counts in a state are relative to the current prefix."""
        alive, last, count = [], None, 0
        for node, before, held in self.entries[state]:
            to = self.trie[node].get(byte)
            if to is None:
                continue
            alive.append((to, before, held))
            token = self.token[to]
            if last is None and token >= 0 and self._follows(before, token):
                last, count = token, held + 1
        assert last is not None, "every byte is a token"
        entries = tuple((n, b, h - count) for n, b, h in alive if self.trie[n]) + ((0, last, 0),)
        move = self.moves[state][byte] = (self._state(entries), count)
        return move

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: the sum of its transitions' annotations."""
        if len(self.entries) > self.MAX_STATES:
            self.reset()
        state, total, moves = self.start, 0, self.moves
        for byte in piece:
            move = moves[state].get(byte)
            if move is None:
                move = self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total


@lru_cache(2)
def transducer(path: str) -> BpeTransducer:
    return BpeTransducer(load_vocabulary(path))
