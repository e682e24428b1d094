"""Byte-level BPE encoding and decoding with DuckDB's recursive queries.

Each Python worker has one small DuckDB. A text is cut by the tokenizer's pattern; the pieces that the
worker hasn't met lately are encoded together: one row for each token's position joins the merge table (left
id, right id, merged id), each piece contracts its leftmost pair of least rank, and the recursion goes on until
no piece has a pair. Ids are turned into bytes again by an ordered aggregation over their positions.

The recursion starts from bytes, of which pairs that are bound to merge are merged already. A pair of bytes is
bound to if it ranks below every merge that could take one of them instead (of any token that ends in the byte on
its left with the left one, of the right one with any token that starts with the byte on its right), and below
every merge that could take the pair itself. Until its turn comes neither byte, nor the pair, then takes part in
another merge, so all others go the same way with or without it, whatever the ranks.

A piece above ``WINDOW`` bytes goes as windows, which are contracted like pieces and then joined two by two.
Neighbours can be joined as they are if the last token of one and the first of the other, contracted together,
stay these two tokens: up to the first merge across the seam both sides contract as if alone, and that merge
depends on nothing but the two tokens. Where they don't stay, some tokens on either side are contracted anew,
twice as many each time, until both seams hold. So memory and steps are bounded by windows, however long a piece.

Ids are those of the tiktoken library's encode_ordinary for the same ranks and pattern.

Cases: a null or empty text has no ids; whole texts are encoded, however long; rows that repeat are
encoded alike; an empty table gives no rows; columns other than the key and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import islice
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import ship, tidy

#: Bytes of a window; 3 times a power of two, so that runs of characters of 1 to 4 bytes fall in step with it.
WINDOW = 48
#: Bytes that are contracted anew around one seam; a longer stretch is worked off from the left.
STRETCH = 768
#: Rows that the steps of one recursion may add up to.
STEP_ROWS = 1_000_000
#: Pieces of one recursive query, ids of one aggregation, characters cut at a time, pieces of a long text taken at a time.
TOGETHER, IDS, CHARACTERS, PIECES = 8_000, 250_000, 1_000_000, 100_000
#: Bytes that a worker's remembered pieces take, about (half of them met since the other half), and what one takes beside its own bytes.
REMEMBERED, ENTRY = 48 << 20, 160
_coders: dict[str, "Coder"] = {}


def read_ranks(file: str | Path) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(file).read_bytes().splitlines() if line)}


#: Rank of a pair that has none.
NEVER = np.iinfo(np.int32).max


def bound_pairs(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three tables by two bytes.

    The id of a pair that may be merged beforehand; the least rank of a merge of any token that ends in the first byte
    with the second byte; the least rank of a merge of the first byte with any token that starts with the second.
    """
    pairs, before, after = (np.full((256, 256), NEVER, np.int32) for _ in range(3))
    for t, i in ranks.items():
        if len(t) == 2 and t[:1] in ranks and t[1:] in ranks:
            pairs[t[0], t[1]] = i
        for k in {1, len(t) - 1} - {0}:
            if t[:k] in ranks and t[k:] in ranks:
                if len(t) - k == 1:
                    before[t[k - 1], t[k]] = min(before[t[k - 1], t[k]], i)
                if k == 1:
                    after[t[0], t[1]] = min(after[t[0], t[1]], i)
    for t, i in ranks.items():  # pairs that a merge of lower rank could take
        for pair, rest in ((t[:2], t[2:]), (t[-2:], t[:-2])):
            if rest in ranks and ranks.get(pair, -1) >= i:
                pairs[pair[0], pair[1]] = NEVER
    return pairs, before, after


def plain_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for Python's own engine, which is faster, and for texts of characters below U+10000.

    None if it asks for more than letters, numbers and white space by name.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))

    def ranges(name: str) -> str:
        found = np.array([ord(c) for c in regex.findall(name, every)])
        return "".join(f"\\u{g[0]:04x}-\\u{g[-1]:04x}" for g in np.split(found, np.flatnonzero(np.diff(found) > 1) + 1))

    named = {name: ranges(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|\[\^?\]?|\(\?.|\{[^}]*\}|.", pattern, re.DOTALL):
        if part in named:
            out.append(named[part] if inside else f"[{named[part]}]")
        elif part == r"\S" and not inside:
            out.append(f"[^{named[r'\s']}]")
        elif part[0] == "\\" or (part[0] == "[" and (inside or part[-1] == "]")) or (part[:2] == "(?" and (inside or part[2] not in ":=!")) or (part[0] == "{" and not re.fullmatch(r"\{\d+(,\d*)?\}", part)):
            return None
        else:
            inside = part[0] == "[" or (inside and part != "]")
            out.append(part)
    return re.compile("".join(out))


#: One pair of each word a step: rows (word, pos, nxt, tok); nxt is the next token's position.
CONTRACT = """
WITH RECURSIVE state(it, word, pos, nxt, tok) AS (
    SELECT 0, word, pos, nxt, tok FROM start
    UNION ALL
    SELECT s.it + 1, s.word, s.pos, CASE WHEN s.pos = b.pos THEN b.after ELSE s.nxt END, CASE WHEN s.pos = b.pos THEN b.merged ELSE s.tok END
    FROM state s JOIN (
        SELECT l.word, (min((m.merged::BIGINT << 34) | l.pos) & 17179869183)::INTEGER AS pos, arg_min(m.merged, (m.merged::BIGINT << 34) | l.pos) AS merged,
               arg_min(l.nxt, (m.merged::BIGINT << 34) | l.pos) AS gone, min_by(coalesce(r.nxt, -1), (m.merged::BIGINT << 34) | l.pos) AS after
        FROM state l JOIN state r ON r.pos = l.nxt JOIN merges m ON m.l = l.tok AND m.r = r.tok
        GROUP BY l.word
    ) b ON s.word = b.word
    WHERE s.pos <> b.gone AND s.it < {steps}
)
SELECT s.it = {steps} AS cut, s.word, s.pos, s.tok FROM state s JOIN (SELECT word, max(it) AS it FROM state GROUP BY word) e ON s.word = e.word AND s.it = e.it
"""

class Coder:
    """Encoder and decoder of one vocabulary in one process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern, self.plain = ranks, regex.compile(pattern), plain_pattern(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        rows = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, merged = np.array(rows, np.int32).reshape(-1, 3).T
        self._table("merges", l=left, r=right, merged=merged)
        self._table("vocabulary", tok=np.array(list(ranks.values()), np.int32), hex=np.array([t.hex() for t in ranks], object))
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs, self.before, self.after = bound_pairs(ranks)

    def _table(self, name: str, **columns: np.ndarray) -> None:
        data = pa.table({k: pa.array(v) for k, v in columns.items()})
        self.db.register("given", data)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _begun(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, position and id of each token after the merges that are bound to come."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        word, pos = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces]), np.arange(len(data), dtype=np.int32)
        seam = word[1:] != word[:-1]
        merged, before, after = (np.where(seam, NEVER, table[data[:-1], data[1:]]) for table in (self.pairs, self.before, self.after))
        goes = merged < NEVER
        goes[1:] &= before[:-1] > merged[1:]
        goes[:-1] &= after[1:] > merged[:-1]
        at = np.flatnonzero(goes)
        tok, stays = self.bytes_ids[data], np.ones(len(data), bool)
        tok[at], stays[at + 1] = merged[at], False
        return word[stays], pos[stays], tok[stays]

    def _contract(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each of some pieces (none empty), by recursion over all of them."""
        word, pos, tok = self._begun(pieces)
        n = np.bincount(word, minlength=len(pieces))
        nxt = np.append(pos[1:], np.int32(-1))
        nxt[np.cumsum(n) - 1] = -1
        self._table("start", word=word, pos=pos, nxt=nxt, tok=tok)
        self.db.execute("CREATE OR REPLACE TEMP TABLE done (word INTEGER, pos INTEGER, tok INTEGER)")
        left = len(tok)
        steps = 100 if (n * (n + 1)).sum() // 2 <= STEP_ROWS else max(1, min(100, STEP_ROWS // left))  # each step shortens a piece by one
        while left:  # a recursion keeps the rows of all its steps, so one goes some steps and the next goes on
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE reached AS {CONTRACT.format(steps=steps)}")
            self.db.execute("INSERT INTO done SELECT word, pos, tok FROM reached WHERE NOT cut")
            self.db.execute("CREATE OR REPLACE TEMP TABLE start AS SELECT word, pos, coalesce(lead(pos) OVER (PARTITION BY word ORDER BY pos), -1) AS nxt, tok FROM reached WHERE cut")
            ((left,),) = self.db.execute("SELECT count(*) FROM start").fetchall()
            steps = max(1, min(100, STEP_ROWS // max(1, left)))
        got = self.db.sql("SELECT word, tok FROM done ORDER BY pos").to_arrow_table()  # positions rise from piece to piece
        ids = got.column("tok").to_numpy().astype("<u4")
        ends = np.searchsorted(got.column("word").to_numpy(), np.arange(len(pieces) + 1)).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _some(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, each different one contracted once, a bounded number at a time."""
        each = list(dict.fromkeys(pieces))
        out: dict[bytes, np.ndarray] = {}
        at = 0
        while at < len(each):
            end, size = at, 0
            while end < len(each) and end - at < TOGETHER and (end == at or size + len(each[end]) <= TOGETHER * WINDOW):
                size += len(each[end])
                end += 1
            out.update(zip(each[at:end], self._contract(each[at:end]), strict=True))
            at = end
        return [out[p] for p in pieces]

    def _bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def _join(self, pairs: list[tuple[np.ndarray, np.ndarray]], stretch: int | None = STRETCH) -> list[np.ndarray | None]:
        """Ids of what each pair of neighbours spells; None where more than ``stretch`` bytes would be contracted anew."""
        out: list[np.ndarray | None] = [None] * len(pairs)
        open_, take = list(range(len(pairs))), 0
        while open_:
            ends = [(pairs[k][0][-take:] if take else pairs[k][0][:0], pairs[k][1][:take]) for k in open_]
            spelled = [self._bytes(a.tolist()) + self._bytes(b.tolist()) for a, b in ends]
            if stretch is not None:
                able = [j for j, s in enumerate(spelled) if len(s) <= stretch]
                open_, spelled = [open_[j] for j in able], [spelled[j] for j in able]
            middles = self._some(spelled) if take else [np.empty(0, np.uint32)] * len(open_)
            joined = []
            for k, m in zip(open_, middles, strict=True):
                left, right = pairs[k][0][: max(0, len(pairs[k][0]) - take)], pairs[k][1][take:]
                parts = [x for x in (left, m, right) if len(x)]
                joined.append((k, parts, [(int(a[-1]), int(b[0])) for a, b in zip(parts, parts[1:], strict=False)]))
            seams = list({s for _, _, some in joined for s in some})
            holds = {s: len(ids) == 2 and tuple(ids.tolist()) == s for s, ids in zip(seams, self._some([self._bytes(s) for s in seams]), strict=True)}
            open_ = []
            for k, parts, some in joined:
                if all(holds[s] for s in some):
                    out[k] = np.concatenate(parts)
                else:
                    open_.append(k)
            take = take * 2 or 2
        return out

    def _after(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of two neighbours that fall in step nowhere near their seam: the right one is worked off from the left."""
        data = self._bytes(right.tolist())
        for at in range(0, len(data), STRETCH // 2):
            chunk = self._contract([data[at : at + STRETCH // 2]])[0]
            left = self._join([(left, chunk)], None)[0]
        return left

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece, of any length (empty: none)."""
        windows = [[p[k : k + WINDOW] for k in range(0, len(p), WINDOW)] for p in pieces]
        flat = iter(self._some([w for some in windows for w in some]))
        rows = [list(islice(flat, len(some))) for some in windows]
        while any(len(r) > 1 for r in rows):
            joined = iter(self._join([(r[k], r[k + 1]) for r in rows for k in range(0, len(r) - 1, 2)]))
            halved = []
            for r in rows:
                both = []
                for k in range(0, len(r) - 1, 2):
                    one = next(joined)
                    both.append(self._after(r[k], r[k + 1]) if one is None else one)
                halved.append(both + r[len(r) - len(r) % 2 :])
            rows = halved
        return [r[0] if r else np.empty(0, np.uint32) for r in rows]

    def _engine(self, text: str) -> re.Pattern | regex.Pattern:
        below = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return self.plain if self.plain and below else self.pattern

    def _cut(self, texts: Iterable[str]) -> Iterator[list[tuple[list[str], bool]]]:
        """Groups of about ``CHARACTERS`` characters: pieces in order, and whether a text ends with them."""
        group: list[tuple[list[str], bool]] = []
        size = 0
        for text in texts:
            if group and size + len(text) > CHARACTERS:
                yield group
                group, size = [], 0
            if len(text) > CHARACTERS:
                match = self._engine(text).finditer(text)
                while some := [m[0] for m in islice(match, PIECES)]:
                    yield [(some, False)]
                group.append(([], True))
            else:
                group.append((self._engine(text).findall(text), True))
                size += len(text)
        if group:
            yield group

    def encode_ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text (little-endian, 32 bits each)."""
        before: list[bytes] = []
        for group in self._cut(texts):
            if self.held > REMEMBERED // 2:  # pieces met since are kept, those before only till the next time
                self.known, self.older, self.held = {}, self.known, 0
            known, older = self.known, self.older
            new, passing = [], {}
            missing = set().union(*(pieces for pieces, _ in group)).difference(known)
            again = {p: older[p] for p in missing if p in older}
            known.update(again)
            self.held += sum(map(len, again)) * 2 + ENTRY * len(again)
            for p in missing.difference(again):
                data = p.encode()
                if (i := self.ranks.get(data)) is not None:
                    known[p] = i.to_bytes(4, "little")
                    self.held += len(p) + ENTRY
                elif len(data) <= WINDOW:
                    new.append(p)
                else:
                    passing[p] = b""
            for k in range(0, len(new), TOGETHER):
                some = new[k : k + TOGETHER]
                known.update(zip(some, [i.tobytes() for i in self._some([p.encode() for p in some])], strict=True))
                self.held += sum(map(len, some)) * 2 + ENTRY * len(some)
            if passing:  # long pieces are rarely met twice
                passing = dict(zip(passing, [i.tobytes() for i in self.encode_pieces([p.encode() for p in passing])], strict=True))
            for pieces, ends in group:
                before.append(b"".join([passing.get(p) or known[p] for p in pieces] if passing else map(known.__getitem__, pieces)))
                if ends:
                    yield b"".join(before)
                    before = []

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each array of ids, by an ordered aggregation; a long array goes in parts."""
        parts = [(x[k : k + IDS], k + IDS >= len(x)) for x in ids for k in range(0, max(1, len(x)), IDS)]
        at, before, decoded = 0, b"", []
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end][0]) <= IDS):
                size += len(parts[end][0])
                end += 1
            some = parts[at:end]
            flat = np.concatenate([x for x, _ in some]).astype(np.int32)
            self._table("start", word=np.repeat(np.arange(len(some), dtype=np.int32), [len(x) for x, _ in some]), pos=np.arange(len(flat), dtype=np.int32), tok=flat)
            out = [""] * len(some)
            got = self.db.sql("SELECT word, string_agg(hex, '' ORDER BY pos) AS hex FROM start JOIN vocabulary USING (tok) GROUP BY word").to_arrow_table()
            for k, h in zip(got.column("word").to_pylist(), got.column("hex").to_pylist(), strict=True):
                out[k] = h
            for (_, ends), h in zip(some, out, strict=True):
                before += bytes.fromhex(h)
                if ends:
                    decoded.append(before)
                    before = b""
            at = end
        return decoded

    def rest(self) -> None:
        """Let go of the last query's tables."""
        for name in ("start", "done", "reached"):
            self.db.execute(f"DROP TABLE IF EXISTS {name}")

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Ids of each text, and the bytes that these ids stand for."""
        held: list[np.ndarray] = []
        size = 0
        for ids in self.encode_ids(texts):
            held.append(np.frombuffer(ids, "<u4"))
            size += len(held[-1])
            if size > IDS:
                yield from ((i.tobytes(), d) for i, d in zip(held, self.decode(held), strict=True))
                held, size = [], 0
        yield from ((i.tobytes(), d) for i, d in zip(held, self.decode(held), strict=True))


def _coder(name: str, ranks: dict[bytes, int], pattern: str) -> Coder:
    if name not in _coders:
        _coders[name] = Coder(ranks, pattern)
    return _coders[name]


def forget() -> None:
    """Let a worker drop its coders."""
    for coder in _coders.values():
        coder.db.close()
    _coders.clear()


def _sent(df: DataFrame, file: str | Path, pattern: str):
    """The vocabulary (a file of fixed size that only the driver needs to have), for the workers."""
    ship(df.sparkSession)
    ranks = read_ranks(file)
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((name, ranks, pattern))


def encode(df: DataFrame, file: str | Path, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids (array of int) and decoded (binary) of every row of df."""
    sent = _sent(df, file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                done = list(coder.encode([t or "" for t in part.column(1).to_pylist()]))
                ends = np.cumsum([0, *(len(i) // 4 for i, _ in done)]).astype(np.int32)
                flat = np.frombuffer(b"".join(i for i, _ in done), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends).astype(np.int64)), ids, pa.array([d for _, d in done], pa.binary())], [key, "n_tokens", "ids", "decoded"])
        coder.rest()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(tidy("bpe", run, forget), f"`{key}` {kind}, n_tokens long, ids array<int>, decoded binary")


def encode_digests(df: DataFrame, file: str | Path, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As encode, with SHA-256 digests in place of ids and bytes, which then stay in the workers."""
    sent = _sent(df, file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        for batch in batches:
            rows = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest()) for i, d in coder.encode([t or "" for t in batch.column(1).to_pylist()])]
            n, ids, decoded = zip(*rows, strict=True) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])
        coder.rest()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(tidy("bpe", run, forget), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(df: DataFrame, file: str | Path, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text (bytes that are not UTF-8 become U+FFFD) of every row of df with token ids."""
    sent = _sent(df, file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [d.decode("utf-8", "replace") for d in coder.decode([np.array(x or [], np.int32) for x in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [key, "text"])
        coder.rest()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(ids).alias("ids")).mapInArrow(tidy("bpe", run, forget), f"`{key}` {kind}, text string")

