"""BPE encoding and decoding by a bounded-lookahead streaming transducer.

The merge list itself tells how far a later byte can reach back into the
tokens before it (``sufficient_lookahead``).  The transducer therefore emits a
token as soon as it ends that many bytes before the end of what it has seen,
and keeps only the rest: its memory does not grow with the text.  Decoding is
the mirror image: token bytes go through an incremental byte-to-text machine
that holds back at most one incomplete character.

Why the lookahead suffices: take the tokens of ``w`` and of ``w + x``.  They
can differ first where a merge joins the last symbol ``a`` of ``w`` with
something from ``x``; the first difference then stands ``len(a)`` bytes
further left.  It moves on only by a rule of *higher* rank whose right part
begins with ``a`` (is ``a`` or was built with ``a`` at its left edge).  So the
reach is the heaviest chain of rules, which ``sufficient_lookahead`` computes
in one pass over the merges from the last to the first.

``digests`` feeds the transducer a window of the text at a time.  No pre-token
crosses a space before a visible character, so windows and the units in them are
cut there, and short units go through a bounded cache of what the transducer gave
for them.  All texts take this way; a stretch without such a space that is longer
than a window streams through it.

Null texts count as empty (no tokens, empty decoded text).  Very long texts
and very long pre-tokens (one letter run of megabytes) stream in pieces.
Repeated rows and ties are independent; extra columns are ignored by the
query and carried by ``BpeCodec`` users as they like.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import trimmed

PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No pre-token crosses this place: what follows starts one, and blanks before it end one.
CUT = re.compile(r" (?=\S)")
CHUNK = 1 << 16
#: Units in each of the two generations of a task's cache.
CACHE = 400_000
NO_RULE = 1 << 30


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_rules(tokenizer_json: str) -> dict:
    """Vocabulary, merges and added tokens of a byte-level tokenizer file, as bytes and ids."""
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    raw = lambda s: bytes(alphabet[c] for c in s)
    vocab = spec["model"]["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    return {"ids": {raw(t): i for t, i in vocab.items()},
            "merges": [(raw(a), raw(b)) for a, b in pairs],
            "added": {t["content"]: t["id"] for t in spec.get("added_tokens", [])}}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which no later input can change a token (see the module text)."""
    left = {a + b: a for a, b in merges}
    heaviest: dict[bytes, int] = {}
    longest = max((len(a) + len(b) for a, b in merges), default=1)
    reach = 0
    for a, b in reversed(merges):
        w = len(a) + heaviest.get(a, 0)
        reach = max(reach, w)
        x = b
        while x is not None:
            if heaviest.get(x, 0) < w:
                heaviest[x] = w
            x = left.get(x)
    return reach + longest


def _one(unit: str) -> bool:
    """A unit of letters is one pre-token, after a space or not; an opening quote may begin a contraction."""
    return unit.isalpha() or unit[0] == " " and unit[1:].isalpha()


class IncrementalText:
    """Byte-to-text state machine: holds back at most one incomplete character."""

    def __init__(self):
        self.rest = b""

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                if back < need:
                    cut = len(data) - back
                break
            if lead < 0x80:
                break
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.rest = self.rest.decode("utf-8", "replace"), b""
        return out


class BpeCodec:
    def __init__(self, rules: dict, cache: int = CACHE):
        self.ids: dict[bytes, int] = rules["ids"]
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.added: dict[str, int] = rules["added"]
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        merges = rules["merges"]
        self.pair_rank = {self.ids[a] << 17 | self.ids[b]: r for r, (a, b) in enumerate(merges)}
        self.made = [self.ids[a + b] for a, b in merges]
        order = sorted(self.pair_rank)
        self.sorted_keys = np.array(order, np.int64)
        self.sorted_ranks = np.array([self.pair_rank[k] for k in order], np.int64)
        self.id_text = {i: b",%d" % i for i in self.bytes_of}
        self.lookahead = sufficient_lookahead(merges)
        self.of_byte = [self.ids.get(bytes([b])) for b in range(256)]
        self.pattern = regex.compile(PRETOKEN)
        self.splitter = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
                                      + ")") if self.added else None
        self.runs = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]
        self.cache_size = cache
        self.units: dict[str, tuple[int, bytes, bytes]] = {}
        self.old: dict[str, tuple[int, bytes, bytes]] = {}

    # -- one piece, whole
    def merge(self, data: bytes) -> list[int]:
        """Apply the merges to a byte string: lowest rank first, leftmost first."""
        part = [self.of_byte[b] for b in data]
        if len(part) > 48:
            return self._merge_long(part)
        get, made = self.pair_rank.get, self.made
        ranks = [get(a << 17 | b, NO_RULE) for a, b in zip(part, part[1:])]  # noqa: B905
        while ranks:
            r = min(ranks)
            if r == NO_RULE:
                break
            i = ranks.index(r)
            part[i : i + 2] = [made[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(part[i - 1] << 17 | part[i], NO_RULE)
            if i < len(ranks):
                ranks[i] = get(part[i] << 17 | part[i + 1], NO_RULE)
        return part

    def _merge_long(self, part: list[int]) -> list[int]:
        """The same merges through a heap of (rank, place) and a linked list."""
        get, made, n = self.pair_rank.get, self.made, len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
                if (r := get(part[i] << 17 | part[i + 1], NO_RULE)) != NO_RULE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if 0 <= x and y < n and (q := get(part[x] << 17 | part[y], NO_RULE)) != NO_RULE:
                    heapq.heappush(heap, (q, x, part[x], part[y]))
        return [t for t in part if t >= 0]

    # -- one pre-token of any length, as a stream of byte pieces
    def transduce(self, pieces: Iterable[bytes]) -> Iterator[int]:
        buffer, hold = b"", 2 * self.lookahead
        for piece in pieces:
            for at in range(0, len(piece), hold):
                buffer += piece[at : at + hold]
                if len(buffer) > hold:
                    done, stable = 0, len(buffer) - self.lookahead
                    for t in self.merge(buffer):
                        end = done + len(self.bytes_of[t])
                        if end > stable:
                            break
                        yield t
                        done = end
                    buffer = buffer[done:]
        yield from self.merge(buffer)

    def word(self, w: str) -> list[int]:
        data = w.encode("utf-8", "surrogatepass")
        return self.merge(data) if len(data) <= 2 * self.lookahead else list(self.transduce([data]))

    # -- a text without added tokens, as a stream of chunks
    def plain(self, chunks: Iterable[str]) -> Iterator[int]:
        """Pre-tokens of a chunk are final but for the last two; a run that fills the whole buffer streams."""
        buffer, stream = "", iter(chunks)
        for chunk in stream:
            buffer += chunk
            if len(buffer) < CHUNK:
                continue
            spans = [m.span() for m in self.pattern.finditer(buffer)]
            if len(spans) > 2:
                for a, b in spans[:-2]:
                    yield from self.word(buffer[a:b])
                buffer = buffer[spans[-3][1]:]
            if len(buffer) >= CHUNK:
                box = [buffer]
                yield from self.transduce(self._run(box, stream))
                buffer = box[0]
        for m in self.pattern.finditer(buffer):
            yield from self.word(m.group())

    def _run(self, box: list[str], stream: Iterator[str]) -> Iterator[bytes]:
        """Bytes of the one long pre-token at the start of ``box[0]``; what follows it is left there."""
        buffer = box[0]
        first = self.pattern.match(buffer).group()
        space = first[0] == " " and not first.isspace()
        kind = next(k for k in self.runs if k.match(first, 1 if space else 0))
        blank = kind is self.runs[3]
        if space:
            yield b" "
            buffer = buffer[1:]
        while True:
            end = kind.match(buffer).end() if buffer and kind.match(buffer) else 0
            more = next(stream, None) if end == len(buffer) else None
            if more is None:
                if blank and end < len(buffer):  # the last blank belongs to what follows, or stands alone
                    end = max(end - 1, 0)
                yield buffer[:end].encode("utf-8", "surrogatepass")
                box[0] = buffer[end:]
                return
            yield buffer[: end - 1].encode("utf-8", "surrogatepass")
            buffer = buffer[end - 1 :] + more

    def encode(self, text: str | None) -> Iterator[int]:
        """Token ids of a whole text, emitted as they become stable."""
        parts = self.splitter.split(text or "") if self.splitter else [text or ""]
        for p in parts:
            if p in self.added:
                yield self.added[p]
            elif p:
                yield from self.plain(p[i : i + CHUNK] for i in range(0, len(p), CHUNK))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        machine = IncrementalText()
        for i in ids:
            yield machine.feed(self.bytes_of[i])
        yield machine.finish()

    # -- digests of a whole text: the same streams, fed a space-delimited unit at a time
    def _entry(self, ids) -> tuple[int, bytes, bytes]:
        return len(ids), b"".join([self.id_text[i] for i in ids]), b"".join([self.bytes_of[i] for i in ids])

    def _keep(self, u: str, got: tuple[int, bytes, bytes]) -> tuple[int, bytes, bytes]:
        if len(u) <= 64:
            if len(self.units) >= self.cache_size:  # two generations: what is used again survives
                self.old, self.units = self.units, {}
            self.units[u] = got
        return got

    def _unit(self, u: str) -> tuple[int, bytes, bytes]:
        """(tokens, their ids each after a comma, their bytes) of one unit; a miss of the young cache."""
        got = self.old.pop(u, None)
        if got is None:
            spans = [u] if _one(u) else self.pattern.findall(u)
            if len(spans) == 1:
                got = self._entry(self.word(u))
            else:
                parts = [self.units.get(w) or self._unit(w) for w in spans]
                got = (sum(g[0] for g in parts), b"".join([g[1] for g in parts]), b"".join([g[2] for g in parts]))
        return self._keep(u, got)

    def _windows(self, text: str) -> Iterator[tuple[list[str], range]]:
        """(units, none) of each window of a text, or (none, starts of the pieces) of a stretch that cannot be cut."""
        at = 0
        while at < len(text):
            cut = CUT.search(text, at + CHUNK)
            end = cut.start() if cut else len(text)
            if end - at > 2 * CHUNK:
                yield [], range(at, end, CHUNK)
            else:
                first, *others = CUT.split(text[at:end])
                yield ([first] if first else []) + [" " + u for u in others], range(end, end)
            at = end

    def warm(self, texts: list[str]) -> None:
        """Merge the unknown words of many texts together, a bounded number of units at a time."""
        new: set[str] = set()
        for t in texts:
            for units, _ in self._windows(t):
                new.update(units)
                if len(new) > CHUNK:
                    self._warm(new)
                    new = set()
        self._warm(new)

    def _warm(self, new: set[str]) -> None:
        """One merge per word and round, all words at once."""
        words: set[str] = set()
        for u in new:
            if len(u) <= 64 and u not in self.units and u not in self.old:
                words.update([u] if _one(u) else self.pattern.findall(u))
        todo = [(w, d) for w in words if w not in self.units and w not in self.old and 1 < len(d := w.encode("utf-8", "surrogatepass")) <= 32]
        for low, width in ((0, 12), (12, 20), (20, 32)):
            some = [(w, d) for w, d in todo if low < len(d) <= width]
            for at in range(0, len(some), 8192):
                part = some[at : at + 8192]
                rows, counts = self._merge_many([d for _, d in part], width)
                for (w, _), ids, n in zip(part, rows, counts, strict=True):
                    self._keep(w, self._entry(ids[:n]))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 17 | b
        at = np.searchsorted(self.sorted_keys, keys)
        at[at == len(self.sorted_keys)] = 0
        return np.where(self.sorted_keys[at] == keys, self.sorted_ranks[at], NO_RULE)

    def _merge_many(self, words: list[bytes], width: int) -> tuple[list, list]:
        n = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        part = np.array(self.of_byte, np.int64)[raw]
        column = np.arange(width)
        ranks = np.full((len(words), width), NO_RULE, np.int64)
        ranks[:, :-1] = self._ranks(part[:, :-1], part[:, 1:])
        ranks[column[None, :] >= (n - 1)[:, None]] = NO_RULE
        live = np.arange(len(words))
        made = np.array(self.made, np.int64)
        while len(live):
            own = ranks[live]
            at = own.argmin(axis=1)
            r = own[np.arange(len(live)), at]
            keep = r != NO_RULE
            live, at, r = live[keep], at[keep], r[keep]
            if not len(live):
                break
            take = np.minimum(column[None, :] + (column[None, :] > at[:, None]), width - 1)
            p = np.take_along_axis(part[live], take, 1)
            q = np.take_along_axis(own[keep], np.minimum(column[None, :] + (column[None, :] >= at[:, None]), width - 1), 1)
            k = np.arange(len(live))
            p[k, at] = made[r]
            n[live] -= 1
            q[:, -1] = NO_RULE
            left = k[at > 0]
            q[left, at[left] - 1] = self._ranks(p[left, at[left] - 1], p[left, at[left]])
            right = k[at < n[live] - 1]
            q[right, at[right]] = self._ranks(p[right, at[right]], p[right, at[right] + 1])
            q[column[None, :] >= (n[live] - 1)[:, None]] = NO_RULE
            part[live], ranks[live] = p, q
        return part.tolist(), n.tolist()

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """(tokens, SHA-256 of the comma-joined ids, SHA-256 of the decoded text)."""
        ids_sha, text_sha, machine, n = hashlib.sha256(), hashlib.sha256(), IncrementalText(), 0
        lead = True

        def take(count: int, ids: bytes, data: bytes) -> None:
            nonlocal n, lead
            if not count:
                return
            ids_sha.update(ids[1:] if lead else ids)
            text_sha.update(machine.feed(data).encode())
            n, lead = n + count, False

        for p in (self.splitter.split(text or "") if self.splitter else [text or ""]):
            if p in self.added:
                take(1, b",%d" % self.added[p], p.encode())
                continue
            for units, pieces in self._windows(p):
                known = self.units
                got = [known.get(u) or self._unit(u) for u in units]
                take(sum(g[0] for g in got), b"".join([g[1] for g in got]), b"".join([g[2] for g in got]))
                stream = self.plain(p[i : min(i + CHUNK, pieces.stop)] for i in pieces)
                while batch := list(islice(stream, 4096)):
                    take(*self._entry(batch))
        text_sha.update(machine.finish().encode())
        return n, ids_sha.hexdigest(), text_sha.hexdigest()


_CODECS: dict[str, BpeCodec] = {}


def digest_documents(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """Encode and decode ``docs(doc_id, text)``; one row of counts and digests per document.

    One narrow pass, no shuffle.  The driver reads the vocabulary file (a
    fixed-size public file) and ships its rules once per executor.
    """
    rules = docs.sparkSession.sparkContext.broadcast(load_rules(tokenizer_json))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _CODECS.get(tokenizer_json)
        if codec is None:
            codec = _CODECS[tokenizer_json] = BpeCodec(rules.value)
        for b in batches:
            texts = b["text"].tolist()
            rows, at = [], 0
            while at < len(texts):  # about a million characters at a time
                end, size = at, 0
                while end < len(texts) and size < 1 << 20:
                    size, end = size + len(texts[end]), end + 1
                codec.warm(texts[at:end])
                rows += [(d, *codec.digests(t)) for d, t in zip(b["doc_id"][at:end], texts[at:end], strict=True)]
                at = end
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
