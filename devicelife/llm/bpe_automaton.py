"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, one *merge gadget* after the other, into the
deterministic automaton over tokens that accepts exactly the tokenizations
byte-pair encoding produces. State ``q(t)`` is "the last token was t". The
gadget of merge ``r: u v -> w`` does three things:

* ``q(u)`` becomes a copy of itself without its ``v`` arc (u followed by v
  would have been merged),
* every state with a ``u`` arc gains a ``w`` arc,
* ``q(w)`` starts as the state that ``v`` led to just before the merge.

So an arc is fixed by the gadgets alone: ``arc(s, t)`` is inherited from the
older of the two tokens' parts as they stood when the newer token was made.
Storing all arcs would take vocabulary-squared cells; :class:`Automaton`
keeps the gadgets (one row per merge) and fills its transition table with
the arcs that texts really use.

A word is encoded by running the automaton over its bytes: from each
reached position the trie of arc labels lists the tokens that start there,
longest first, and the transition table says which of them may follow the
last one. At most one token path reaches any position (BPE gives each prefix
one tokenization), so a position that fails is never tried twice and the
walk is linear in practice. Decoding emits the arc labels of the ids and
reads them as UTF-8 (malformed sequences become U+FFFD).

Edge cases: a null text counts as empty (no ids); the vocabulary's added
tokens inside a text (``<|endoftext|>``) are cut out first, as the file
says; repeated rows give repeated rows; extra columns are ignored unless
named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import codepoints, slabs

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
_UNKNOWN = 4
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return {chr(b if b in set(printable) else next(spare)): b for b in range(256)}


class Automaton:
    """Gadgets, trie of arc labels and the lazily filled transition table of one vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int] | None = None):
        letters = byte_letters()
        self.added = dict(added or {})
        n = max([*vocab.values(), *self.added.values()], default=-1) + 1
        labels = [b""] * n
        for t, i in vocab.items():
            labels[i] = bytes(letters[c] for c in t)
        for t, i in self.added.items():
            labels[i] = t.encode()
        self.offsets = array("q", np.concatenate([[0], np.cumsum([len(b) for b in labels], dtype=np.int64)]).tobytes())
        self.labels = b"".join(labels)
        # gadget tables: when a token was made (bytes: -1, never: -2), from which two, and when a pair merges
        self.made = array("i", [-1 if len(b) == 1 else -2 for b in labels])
        self.left, self.right = array("i", [-1]) * n, array("i", [-1]) * n
        self.merged: dict[int, int] = {}
        for r, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            # no v arc out of q(u) so far: the pair never meets and the gadget adds nothing
            if self.made[u] >= -1 and self.made[v] >= -1 and self._unfold(u, v, r - 1):
                self.merged[u << 32 | v] = r
                if self.made[w] >= -1:
                    raise ValueError(f"two merges make the token {a + b!r}")
                self.made[w], self.left[w], self.right[w] = r, u, v
        pairs = np.array(sorted(self.merged), dtype=np.int64)
        self.pairs = np.append(pairs, -1) if not len(pairs) else pairs
        self.ranks = np.array([self.merged.get(k, 1 << 61) for k in self.pairs.tolist()], dtype=np.int64)
        self._trie([i for i in range(n) if self.made[i] >= -1])
        self.table: dict[int, bool] = {}

    WIDE = 24            # words of up to this many bytes are walked together, as arrays
    SLOTS = 1 << 19      # direct-mapped transition table for them
    KEPT = 100_000       # transitions kept for longer words

    def _trie(self, tokens: list[int]) -> None:
        """The trie of the labels of the tokens that the gadgets make, as sorted edges (node << 8 | byte).
        Nodes are numbered level by level in the order of their edges, so an edge's place tells its child.
        ``shorter``: for each token the longest shorter token that its label begins with."""
        n = len(self.made)
        text, starts = np.frombuffer(self.labels, dtype=np.uint8), np.frombuffer(self.offsets, dtype=np.int64)
        live = np.array(tokens, dtype=np.int64)
        size = (starts[1:] - starts[:-1])[live]
        sizes, shorter = np.zeros(n, dtype=np.int32), np.full(n, -1, dtype=np.int32)
        sizes[live] = size
        node, best = np.ones(len(live), dtype=np.int64), np.full(len(live), -1, dtype=np.int32)
        edges, accepts, known, depth = [], [np.full(2, -1, dtype=np.int32)], 2, 0      # node 0: none, node 1: the root
        while len(live):
            key, child = np.unique(node << 8 | text[starts[live] + depth], return_inverse=True)
            edges.append(key)
            ends = size == depth + 1
            here = np.full(len(key), -1, dtype=np.int32)
            here[child[ends]] = live[ends]
            accepts.append(here)
            shorter[live[ends]] = best[ends]
            best = np.where(here[child] >= 0, here[child], best)
            node = child + known
            known += len(key)
            live, size, node, best, depth = live[~ends], size[~ends], node[~ends], best[~ends], depth + 1
        self.edges = np.concatenate(edges) if edges else np.zeros(0, dtype=np.int64)
        self.accepts = np.concatenate(accepts)
        self.size, self.shorter = array("i", sizes.tobytes()), array("i", shorter.tobytes())
        self.sizes, self.shorters = np.frombuffer(self.size, dtype=np.int32), np.frombuffer(self.shorter, dtype=np.int32)
        self.slot_key, self.slot_arc = np.full(self.SLOTS, -1, dtype=np.int64), np.zeros(self.SLOTS, dtype=bool)

    def label(self, i: int) -> bytes:
        return self.labels[self.offsets[i]:self.offsets[i + 1]]

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Children of the nodes (0: none)."""
        if not len(self.edges):
            return np.zeros(len(node), dtype=np.int64)
        key = node << 8 | byte
        at = np.searchsorted(self.edges, key)
        return np.where(self.edges[np.minimum(at, len(self.edges) - 1)] == key, at + 2, 0)

    def arcs(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """:meth:`arc` for arrays of pairs."""
        key = s.astype(np.int64) << 32 | t
        slot = (key * 0x9E3779B1 >> 7) & (self.SLOTS - 1)
        miss = np.flatnonzero(self.slot_key[slot] != key)
        out = self.slot_arc[slot]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            known = self._unfold_all(new >> 32, new & 0xFFFFFFFF)
            out[miss] = known[back]
            self.slot_key[slot[miss]], self.slot_arc[slot[miss]] = key[miss], out[miss]
        return out

    def _unfold_all(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """:meth:`_unfold` for arrays of pairs, all gadgets applied."""
        made, left, right = (np.frombuffer(x, dtype=np.int32) for x in (self.made, self.left, self.right))
        out = np.zeros(len(s), dtype=bool)
        live, last = np.arange(len(s)), np.full(len(s), 1 << 60)
        while len(live):
            key = s << 32 | t
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            a, b = made[s].astype(np.int64), made[t].astype(np.int64)
            no = (self.pairs[at] == key) & (self.ranks[at] <= last)
            yes = ~no & (a < 0) & (b < 0)             # two bytes of the universal automaton
            out[live[yes]] = True
            on = ~(no | yes)
            s, t, a, b, live, last = s[on], t[on], a[on], b[on], live[on], last[on]
            s, t, last = np.where(a >= b, right[s], s).astype(np.int64), np.where(b >= a, left[t], t).astype(np.int64), np.where(a >= b, a - 1, b)
        return out

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """:meth:`encode_word` for many words; short ones walk the automaton in step."""
        out: list = [None] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) <= self.WIDE:
                short.append(i)
            else:
                out[i] = self.encode_word(w)
        for k in range(0, len(short), 20_000):
            part = short[k:k + 20_000]
            for i, ids in zip(part, self._walk([words[i] for i in part])):
                out[i] = ids
        return out

    def _walk(self, words: list[bytes]) -> list[list[int]]:
        many, wide = len(words), max(map(len, words))
        text = np.frombuffer(b"".join([w.ljust(wide, b"\0") for w in words]), dtype=np.uint8).reshape(many, wide)
        size = np.array([len(w) for w in words])
        # longest token from every position
        best = np.full((many, wide + 1), -1, dtype=np.int32)
        row, col = np.nonzero(np.arange(wide) < size[:, None])
        best[row, col] = self._longest(text.reshape(-1), row * wide + col, row * wide + size[row])
        path = np.zeros((many, wide), dtype=np.int32)
        dead = np.zeros((many, wide + 1), dtype=bool)
        depth, here = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
        token, live = best[:, 0].copy(), np.arange(many)
        while len(live):
            t = token[live]
            stuck = live[t < 0]
            if len(stuck):                   # one step back, next shorter arc
                if (depth[stuck] == 0).any():
                    raise ValueError("the vocabulary has no token for a byte of the text")
                dead[stuck, here[stuck]] = True
                depth[stuck] -= 1
                back = path[stuck, depth[stuck]]
                here[stuck] -= self.sizes[back]
                token[stuck] = self.shorters[back]
            moving = live[t >= 0]
            t = t[t >= 0]
            end = here[moving] + self.sizes[t]
            ok = ~dead[moving, end]
            inner = np.flatnonzero(ok & (depth[moving] > 0))
            ok[inner] = self.arcs(path[moving[inner], depth[moving[inner]] - 1], t[inner])
            token[moving[~ok]] = self.shorters[t[~ok]]
            go, t, end = moving[ok], t[ok], end[ok]
            path[go, depth[go]] = t
            depth[go] += 1
            here[go] = end
            token[go] = best[go, end]
            live = live[here[live] < size[live]]
        return [p[:d] for p, d in zip(path.tolist(), depth.tolist())]

    def _longest(self, text: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest token that starts at each of the places and goes no further than its end (-1: none)."""
        best = np.full(len(at), -1, dtype=np.int32)
        live, node, far = np.arange(len(at)), np.ones(len(at), dtype=np.int64), at.copy()
        while len(live):
            node = self.step(node, text[far])
            token = self.accepts[node]
            good = token >= 0
            best[live[good]] = token[good]
            far = far + 1
            on = (node > 0) & (far < ends[live])
            live, node, far = live[on], node[on], far[on]
        return best

    @staticmethod
    def load(path: str) -> "Automaton":
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return Automaton(model["vocab"], pairs, {t["content"]: t["id"] for t in spec.get("added_tokens", [])})

    def arc(self, s: int, t: int) -> bool:
        """Whether token t may follow token s after all gadgets."""
        key = s << 32 | t
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= self.KEPT:
                self.table.clear()
            known = self.table[key] = self._unfold(s, t)
        return known

    def _unfold(self, s: int, t: int, last: int = 1 << 60) -> bool:
        """The arc when the gadgets up to and including number ``last`` have been applied."""
        made, left, right, merged = self.made, self.left, self.right, self.merged
        while True:
            if merged.get(s << 32 | t, 1 << 61) <= last:
                return False
            a, b = made[s], made[t]
            if a < 0 and b < 0:
                return True                  # two bytes of the universal automaton
            if a > b:                        # q(s) began as the state behind its second part
                s, last = right[s], a - 1
            elif b > a:                      # a t arc goes out where its first part's did
                t, last = left[t], b
            else:                            # s is t: both of the above
                s, t, last = right[s], left[t], a - 1

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-split word, by a longest-arc-first walk over the automaton."""
        n, at, last = len(word), 0, -1
        dead, path = bytearray(n + 1), []
        size, shorter, table = self.size, self.shorter, self.table
        text, first, longest = np.frombuffer(word, dtype=np.uint8), 0, array("i")

        def start(at: int) -> int:
            """The longest token from a place, looked up for a stretch of the word at a time."""
            nonlocal first, longest
            if not first <= at < first + len(longest):
                first = at - at % 65_536
                places = np.arange(first, min(n, first + 65_536))
                longest = array("i", self._longest(text, places, np.full(len(places), n)).tobytes())
            return longest[at - first]

        t = start(0)
        while True:
            while t >= 0:
                end = at + size[t]
                if not dead[end]:
                    if last < 0:
                        break
                    known = table.get(last << 32 | t)
                    if known is None:
                        known = self.arc(last, t)
                    if known:
                        break
                t = shorter[t]
            if t < 0:                        # no arc leads on from here: one step back, next shorter arc
                if not path:
                    raise ValueError("the vocabulary has no token for a byte of the text")
                dead[at] = 1
                t = path.pop()
                at -= size[t]
                last = path[-1] if path else -1
                t = shorter[t]
                continue
            path.append(t)
            if end == n:
                return path
            at, last = end, t
            t = start(at)

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.label(i) for i in ids]).decode("utf-8", "replace")


class Splitter:
    """Vectorised pre-splitting of byte-level vocabularies: contractions, then runs of letters,
    numbers or other characters with an optional space in front, then white space."""

    #: The contraction endings of the split pattern.
    ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

    def __init__(self, probe=None):
        kinds = np.full(0x110000, OTHER, dtype=np.int8)
        for cp in range(0x110000):
            g = unicodedata.category(chr(cp))
            if g[0] == "L":
                kinds[cp] = LETTER
            elif g[0] == "N":
                kinds[cp] = NUMBER
            elif g == "Cn":
                kinds[cp] = _UNKNOWN
        kinds[_WHITE] = SPACE
        self.kinds, self.probe = kinds, probe

    def kinds_of(self, cp: np.ndarray) -> np.ndarray:
        k = self.kinds[cp]
        if (k == _UNKNOWN).any():            # newer than this Python's Unicode tables
            for c in np.unique(cp[k == _UNKNOWN]).tolist():
                self.kinds[c] = self.probe(chr(c)) if self.probe else OTHER
            k = self.kinds[cp]
        return k

    def starts(self, cp: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where words start, for texts that begin at ``begin`` (words never cross a begin)."""
        n = len(cp)
        kind = self.kinds_of(cp)
        first = np.zeros(n, dtype=bool)
        first[begin] = True
        cut = first.copy()
        cut[1:] |= kind[1:] != kind[:-1]
        # contractions: an apostrophe that begins a word of its own takes its ending with it
        apos = np.flatnonzero((cp == 39) & cut)
        apos = apos[(apos == 0) | first[apos] | (cp[np.maximum(apos - 1, 0)] != 32)]
        follow = np.append(first, True)
        padded = np.concatenate([cp, np.zeros(3, dtype=cp.dtype)])
        after = np.append(first, [True, True, True])
        taken = np.zeros(len(apos), dtype=np.int64)
        for e in self.ENDINGS:
            hit = (taken == 0) & (apos + len(e) < n + 1)
            for j, c in enumerate(e, 1):
                hit &= (padded[apos + j] == ord(c)) & ~after[apos + j]
            taken[hit] = len(e)
        apos, taken = apos[taken > 0], taken[taken > 0]
        cut[apos + 1] = False
        stop = apos + 1 + taken
        cut[stop[stop < n]] = True
        cut |= first
        del follow
        # white space: a run gives its last character to what follows, when something follows
        space = kind == SPACE
        end_of_run = space & ~np.append(space[1:] & ~first[1:], False)
        lone = end_of_run & ~np.append(first[1:], True)      # followed by a non-space of the same text
        cut[lone] = True
        plain = np.flatnonzero(lone & (cp == 32))
        cut[plain + 1] = False                               # the space joins the next word
        return np.flatnonzero(cut)


def _probe(path: str):
    """Class of one character as the vocabulary file's own splitter sees it (only for code
    points that Python's Unicode tables do not know yet)."""
    split = None

    def kind(c: str) -> int:
        nonlocal split
        if split is None:                    # few texts have such a character
            from tokenizers import Tokenizer
            split = Tokenizer.from_file(path).pre_tokenizer
        spans = [s for _, s in split.pre_tokenize_str(f"a{c}b1{c}2!{c}!")]
        return LETTER if (0, 3) in spans else NUMBER if (3, 6) in spans else OTHER if (6, 9) in spans else SPACE
    return kind


class Encoder:
    """Per-process encoder: the automaton, the splitter and the words met lately.

    ``most`` bounds the memory of the words kept, in bytes: they are kept in two halves, and when the
    newer one is full it becomes the older one, so words in use stay."""

    _made: dict[str, "Encoder"] = {}
    #: About what Python takes for one word's entry besides its bytes.
    ENTRY = 280

    def __init__(self, path: str, most: int = 64 << 20):
        self.automaton = Automaton.load(path)
        self.splitter = Splitter(_probe(path))
        self.new: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.old: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.most, self.held = most, 0

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made = {path: cls(path)}
        return cls._made[path]

    def words(self, distinct: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """(number of ids, ids as text, emitted arc labels) of pre-split words."""
        label, wide = self.automaton.label, self.automaton.WIDE
        out = list(map(self.new.get, distinct))
        missing = []
        for i in [i for i, got in enumerate(out) if got is None]:
            w = distinct[i]
            got = out[i] = self.old.get(w)
            if got is None:
                missing.append(i)
            else:
                self._keep(w, got)
        for i, ids in zip(missing, self.automaton.encode_words([distinct[i] for i in missing])):
            w, emitted = distinct[i], b"".join([label(t) for t in ids])
            out[i] = (len(ids), ",".join(map(str, ids)).encode(), w if emitted == w else emitted)
            if len(w) <= wide:
                self._keep(w, out[i])
        return out

    def _keep(self, word: bytes, got: tuple[int, bytes, bytes]) -> None:
        self.new[word] = got
        self.held += self.ENTRY + 2 * len(word)
        if self.held > self.most // 2:
            self.old, self.new, self.held = self.new, {}, 0

    def pieces(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at added tokens: (ordinary text, None) or (token, its id)."""
        out: list[tuple[str, int | None]] = [(text, None)]
        for token, i in self.automaton.added.items():
            if token in text:
                cutup: list[tuple[str, int | None]] = []
                for piece, known in out:
                    if known is not None:
                        cutup.append((piece, known))
                        continue
                    for k, part in enumerate(piece.split(token)):
                        if k:
                            cutup.append((token, i))
                        if part:
                            cutup.append((part, None))
                out = cutup
        return out

    def encode(self, texts: list[str]) -> Iterator[list[tuple[int, bytes, bytes]]]:
        """For each text its words, each as :meth:`words` gives them."""
        for lo, hi in slabs(texts):
            yield from self._slab(texts[lo:hi])

    def _slab(self, texts: list[str]):
        parts, owner, special = [], [], {}
        for d, t in enumerate(texts):
            for piece, known in self.pieces(t) if t else ():
                if known is not None:
                    special[len(parts)] = known
                parts.append(piece)
                owner.append(d)
        out: list[list] = [[] for _ in texts]
        plain = [p for p in range(len(parts)) if p not in special]
        found: dict[int, list] = {}
        if plain:
            cp, begin = codepoints([parts[p] for p in plain])
            # code points to UTF-8 byte positions: words are keyed by their bytes
            width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
            raw = "".join(parts[p] + "\n" for p in plain).encode("utf-8")
            at = np.concatenate([[0], np.cumsum(width)])
            ends = begin[1:] - 1                              # the separating line feeds are no text
            marked = np.sort(np.concatenate([begin[:-1], ends]))
            cuts = self.splitter.starts(cp, marked)
            stops = np.append(cuts[1:], len(cp))
            real = ~np.isin(cuts, ends)
            b0, b1 = at[cuts[real]], at[stops[real]]
            which, words = self._distinct(raw, b0, b1)
            rows = np.empty(len(words), dtype=object)
            rows[:] = self.words(words)
            coded = rows[which]
            edges = np.searchsorted(cuts[real], begin)
            for k, p in enumerate(plain):
                found[p] = coded[edges[k]:edges[k + 1]].tolist()
        for p, d in enumerate(owner):
            if p in special:
                i = special[p]
                out[d].append((1, str(i).encode(), self.automaton.label(i)))
            else:
                out[d] += found[p]
        return out

    @staticmethod
    def _distinct(raw: bytes, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Which distinct word each word is. Words of up to 7 bytes are compared as one integer
        (bytes and length, exactly); longer ones by their bytes."""
        buf = np.frombuffer(raw + bytes(8), dtype=np.uint8)
        lanes = np.ndarray(shape=(len(raw),), dtype="<u8", buffer=buf.data, strides=(1,))
        size = b1 - b0
        short = np.flatnonzero(size <= 7)
        which = np.empty(len(b0), dtype=np.int64)
        key = lanes[b0[short]] & ((np.uint64(1) << (size[short] * 8).astype(np.uint64)) - np.uint64(1))
        key |= size[short].astype(np.uint64) << np.uint64(56)
        _, one, back = np.unique(key, return_index=True, return_inverse=True)
        words = [raw[i:j] for i, j in zip(b0[short][one].tolist(), b1[short][one].tolist())]
        which[short] = back
        ids: dict[bytes, int] = {}
        rest = np.flatnonzero(size > 7)
        n = len(words)
        which[rest] = [n + ids.setdefault(raw[i:j], len(ids)) for i, j in zip(b0[rest].tolist(), b1[rest].tolist())]
        return which, words + list(ids)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode whole texts; one row per row of ``docs``.

    ``path`` is the vocabulary file, present on every executor. Returns the
    ``keep`` columns and n_tokens, ids_sha256 (of the decimal ids joined by
    commas), decoded_sha256 (of the decoded text) and, with ``with_ids``,
    ``ids`` (array of int) and ``decoded``.
    """
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    fields = [src.schema[k] for k in keep]
    fields += [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
               StructField("decoded_sha256", StringType())]
    schema = StructType(fields)
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType())).add("decoded", StringType())

    def run(batches):
        enc = Encoder.of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            rows = [[], [], [], [], []]
            for words in enc.encode(texts):
                raw = b"".join([w[2] for w in words])
                try:
                    raw.decode("utf-8")
                except UnicodeDecodeError:
                    raw = raw.decode("utf-8", "replace").encode("utf-8")
                rows[0].append(sum([w[0] for w in words]))
                rows[1].append(hashlib.sha256(b",".join([w[1] for w in words])).hexdigest())
                rows[2].append(hashlib.sha256(raw).hexdigest())
                if with_ids:
                    rows[3].append([int(i) for w in words for i in w[1].split(b",") if i])
                    rows[4].append(raw.decode("utf-8"))
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
            if with_ids:
                arrays += [pa.array(rows[3], pa.list_(pa.int32())), pa.array(rows[4], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return src.mapInArrow(run, schema)
