"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decode.

Encoding. A sequence of vocabulary tokens is the BPE encoding of a piece exactly if every two
neighbours are: merging the bytes of the pair gives the pair back. So each prefix of a piece
has one last token, and the encoding can be read off left to right by an automaton. Its state
holds, for every start from which the bytes read so far lead on in the vocabulary's trie: the
trie node, the last token before that start, and the tokens not yet emitted on the way there.
What all starts have in common is emitted at once, which bounds the lookahead by the longest
token. States are made when first met and kept in a table of bounded size; beyond it the table
is emptied and filled anew. All tables of a worker are bounded in bytes.

Decoding. Token bytes are joined in chunks; an incremental UTF-8 state machine holds back the
bytes of a character that a chunk leaves open.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import struct
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, map_arrow, sole

CHUNK = 4096
#: States and pairs that a worker keeps, and bytes of pieces in either half of its table; about 150 MB in all.
MAX_STATES, MAX_PAIRS, PIECE_BYTES = 200_000, 100_000, 48 << 20
#: What a piece in the table takes beside its letters and ids.
_ENTRY = 190


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file; read on the driver, a vocabulary is of bounded size."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Trie:
    """The vocabulary by bytes, in flat arrays: nodes are numbered level by level, so node n's children have neighbouring numbers."""

    def __init__(self, ranks: dict[bytes, int]):
        words = sorted(ranks)
        labels, first, ends = bytearray(b"\0"), array("I"), array("i")
        level = [(0, len(words))]
        depth = 0
        while level:
            below = []
            for lo, hi in level:
                own = lo < hi and len(words[lo]) == depth
                ends.append(ranks[words[lo]] if own else -1)
                first.append(len(labels))
                at = lo + own
                while at < hi:
                    byte = words[at][depth]
                    end = at + 1
                    while end < hi and words[end][depth] == byte:
                        end += 1
                    labels.append(byte)
                    below.append((at, end))
                    at = end
            level = below
            depth += 1
        first.append(len(labels))
        self.labels, self.first, self.ends = bytes(labels), first, ends

    def child(self, node: int, byte: int) -> int:
        """The node that the byte leads to, -1 if none."""
        return self.labels.find(byte, self.first[node], self.first[node + 1])

    def leaf(self, node: int) -> bool:
        return self.first[node] == self.first[node + 1]


class Transducer:
    """Encodes pieces by the ranks; a piece that is a token itself is that token.

    A state is kept as packed numbers: of each start its trie node, last token, and how many and
    which tokens are not yet emitted. Transitions are one table from (state, byte) to (state, output).
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for b, i in ranks.items():
            self.token[i] = b
        self.trie = Trie(ranks)
        self.pairs: dict[int, bool] = {}
        self.single: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self._reset()

    def _reset(self) -> None:
        start = array("i", (0, -1, 0)).tobytes()
        self.ids = {start: 0}
        self.states = [start]
        self.outputs: list[tuple[int, ...]] = [()]
        self.output_ids: dict[tuple[int, ...], int] = {(): 0}
        self.next: dict[int, int] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Tokens by merging neighbours, lowest rank first, leftmost of equals."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def spine(self, t: int, side: int) -> list[tuple[bytes, int]]:
        """The parts of token t that lie at its end (side 1) or start (side 0) while it is merged, each with the rank that consumes it."""
        if (found := self.spines[side].get(t)) is None:
            if len(self.spines[side]) > 4000:
                self.spines[side].clear()
            found, b, until = [], self.token[t], 1 << 60
            while True:
                found.append((b, until))
                if len(b) == 1:
                    break
                until = self.ranks[b]
                b = self._halves(b)[side]
            self.spines[side][t] = found
        return found

    def _halves(self, b: bytes) -> list[bytes]:
        """The two parts whose merge makes the token b."""
        parts = [b[i : i + 1] for i in range(len(b))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def fits(self, before: int, after: int) -> bool:
        """Whether merging keeps the tokens apart: no part at the end of one and part at the start of the other, both there at the time, merge first."""
        if before < 0:
            if (ok := self.single.get(after)) is None:
                ok = self.single[after] = self.merge(self.token[after]) == [after]
            return ok
        key = before << 32 | after
        if (ok := self.pairs.get(key)) is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            ok = self.fits(-1, after)
            if ok:
                rank = self.ranks.get
                for x, x_until in self.spine(before, 1):
                    for y, y_until in self.spine(after, 0):
                        r = rank(x + y)
                        if r is not None and r < x_until and r <= y_until:  # of equal ranks the left merge comes first
                            ok = False
            self.pairs[key] = ok
        return ok

    def _starts(self, state: int) -> list[tuple[int, int, tuple[int, ...]]]:
        """The state's starts: trie node, last token, tokens held."""
        packed, out, at = array("i"), [], 0
        packed.frombytes(self.states[state])
        while at < len(packed):
            n = packed[at + 2]
            out.append((packed[at], packed[at + 1], tuple(packed[at + 3 : at + 3 + n])))
            at += 3 + n
        return out

    def _step(self, state: int, byte: int) -> int:
        """A transition, kept as state << 32 | output."""
        live, fresh = [], None
        child, trie = self.trie.child, self.trie
        for node, last, held in self._starts(state):
            to = child(node, byte)
            if to < 0:
                continue
            if not trie.leaf(to):
                live.append((to, last, held))
            if fresh is None and (t := trie.ends[to]) >= 0 and self.fits(last, t):
                fresh = (0, t, (*held, t))
        if fresh is not None:
            live.append(fresh)
        emitted = ()
        while live and (first := live[0][2][:1]):
            for start in live:
                if start[2][:1] != first:
                    break
            else:
                emitted += first
                live = [(n, t, h[1:]) for n, t, h in live]
                continue
            break
        key = array("i", [x for n, t, h in live for x in (n, t, len(h), *h)]).tobytes()
        to = self.ids.setdefault(key, len(self.states))
        if to == len(self.states):
            self.states.append(key)
        output = self.output_ids.setdefault(emitted, len(self.outputs))
        if output == len(self.outputs):
            self.outputs.append(emitted)
        found = self.next[state << 8 | byte] = to << 32 | output
        return found

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        at, table = 0, self.next
        for byte in piece:
            to = table.get(at << 8 | byte)
            if to is None:
                if len(self.states) > MAX_STATES:  # only the current state is kept
                    now = self.states[at]
                    self._reset()
                    at = self.ids.setdefault(now, 1)
                    if at:
                        self.states.append(now)
                    table = self.next
                to = self._step(at, byte)
            at = to >> 32
            if to & 0xFFFFFFFF:
                out += self.outputs[to & 0xFFFFFFFF]
        for node, _, held in self._starts(at):
            if node == 0:
                return out + list(held)
        raise ValueError("the vocabulary lacks a byte of the piece")


class Utf8Stream:
    """Incremental UTF-8: feed() gives the text of all complete characters, finish() the rest, malformed bytes as U+FFFD."""

    def __init__(self):
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        keep = 0
        for back in range(1, min(4, len(data) + 1)):  # the last lead byte tells whether its character is complete
            x = data[-back]
            if x & 0xC0 == 0x80:
                continue
            need = 4 if x >= 0xF0 else 3 if x >= 0xE0 else 2 if x >= 0xC0 else 1
            keep = back if need > back else 0
            break
        self.open = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids, token: list[bytes]):
    """Bytes of the ids, chunk by chunk."""
    it = iter(ids)
    while part := list(itertools.islice(it, CHUNK)):
        yield b"".join(map(token.__getitem__, part))


def latin_pattern(pattern: str) -> str | None:
    """The pattern with classes spelled out for U+0000 to U+00FF, where re can take them; None if it has other escapes of properties."""
    kind = lambda k: "".join(re.escape(chr(x)) for x in range(256) if unicodedata.category(chr(x))[0] == k)
    spelled = {r"\p{L}": kind("L"), r"\p{N}": kind("N"), r"\s": r"\t-\r \x85\xa0"}

    def put(m: re.Match) -> str:
        found = m[0]
        if found == r"\S":
            return f"[^{spelled[chr(92) + 's']}]"
        if found in spelled:
            return f"[{spelled[found]}]"
        for a, b in spelled.items():
            found = found.replace(a, b)
        return found

    out = re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", put, pattern)
    return None if re.search(r"\\[pPwWdDbBSX]", out) else out


class Encoder:
    """Splits texts by a pattern, encodes each distinct piece once while a table of bounded size holds it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        # Rust's \s is the property White_Space, without U+001C to U+001F.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"[^\p{White_Space}]")).findall
        latin = latin_pattern(pattern)
        self.split_latin = re.compile(latin).findall if latin else self.split
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        """Matches of the pattern; in a text of U+0000 to U+00FF only, by the faster of two equal machines."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split(text)
        return self.split_latin(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.pieces(text)
        known = self.known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            pass
        if self.held > PIECE_BYTES:  # the older half is what has not been met since the last change
            self.older, self.known, self.held = known, {}, 0
            known = self.known
        long: dict[str, bytes] = {}
        for p in {p for p in pieces if p not in known}:
            packed = self.older.get(p)
            if packed is None:
                packed = struct.pack(f"<{len(ids := self.machine.encode(p.encode()))}I", *ids)
            if len(p) <= 64:
                known[p] = packed
                self.held += _ENTRY + len(p) + len(packed)
            else:
                long[p] = packed
        if long:
            return b"".join(known.get(p) or long[p] for p in pieces)
        return b"".join(map(known.__getitem__, pieces))


_encoders: dict[tuple, Encoder] = {}


def _encoder_table() -> dict:
    return _encoders


def _encoder(key: tuple, ranks: dict[bytes, int], pattern: str) -> Encoder:
    sole(_encoders)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pattern)
    return _encoders[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_decoded_chars of every row of docs(doc_id, text).

    ids=True adds token_ids (array<int>). Null texts count as empty and have no tokens; repeated
    rows give equal results; other columns of docs are ignored; an empty table gives no rows.
    path: a tiktoken file that the driver can read; its ranks are broadcast (a vocabulary is bounded).
    """
    ranks = load_ranks(path)
    shared, key = docs.sparkSession.sparkContext.broadcast(ranks), (path, len(ranks), pattern)

    def run(batches):
        enc = _encoder(key, shared.value, pattern)
        token = enc.machine.token
        for part, texts in blocks(batches):
            rows = []
            for t in texts:
                packed = enc.encode(t.decode("utf-8", "replace"))
                tokens = np.frombuffer(packed, "<u4")
                sha, chars, stream = hashlib.sha256(), 0, Utf8Stream()
                for chunk in decode_stream(tokens.tolist(), token):
                    sha.update(chunk)
                    chars += len(stream.feed(chunk))
                rows.append((len(tokens), hashlib.sha256(packed).hexdigest(), sha.hexdigest(), chars + len(stream.finish()), tokens if ids else None))
            n, a, b, c, all_ids = zip(*rows, strict=True)
            out = [part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(c, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_decoded_chars"]
            if ids:
                out.append(pa.array([x.astype(np.int32) for x in all_ids], pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_decoded_chars long" + ", token_ids array<int>" * ids
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, schema, _encoder_table)
