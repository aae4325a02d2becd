"""Token ids of whole texts by the tokenizers library, for a byte-level BPE vocabulary.

Such a tokenizer first cuts a text into pieces and then merges inside each piece, so the ids of a text
are those of its pieces, end to end.  Pieces are found here for a whole Arrow block at once and the
library encodes each distinct piece once, not each occurrence.  Characters whose class depends on the
Unicode version are not judged here: a text that has one is encoded by the library as it is.  So is a text that
holds an added token such as <|endoftext|>, which the library cuts out before it finds pieces.
"""

import functools
import itertools
import os
import unicodedata

import numpy as np
import pyarrow as pa

from closepass.llm import words as W

VOCABULARY = "byte_bpe_50k.json"
BLOCK_BYTES = 1 << 20
KEPT_PIECES = 2_000_000

LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
#: What may follow an apostrophe to make a piece with it.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each code point (of the first plane; the rest is unsure), and its value for hashing."""
    old = unicodedata.ucd_3_2_0
    kinds = np.full(0x110000, UNSURE, dtype=np.uint8)
    for c in range(0x10000):
        x = chr(c)
        category = unicodedata.category(x)
        if old.category(x) != category or category in ("Cn", "Cs", "Co"):
            continue
        if x.isspace() and not 0x1C <= c <= 0x1F:
            kinds[c] = SPACE if c < 0x100 else UNSURE
        else:
            kinds[c] = {"L": LETTER, "N": NUMBER}.get(category[0], OTHER)
    return kinds, W.mixed(np.arange(1, 0x10001, dtype=np.uint64))


def piece_starts(code: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Flags of code points that start a piece; `begins`: where non-empty texts begin."""
    first = np.zeros(len(code), dtype=bool)
    first[begins] = True
    start = first.copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    # of white space before something else, the last character stands alone or joins what follows
    at = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~first[1:])
    start[at] = True
    start[at[code[at] == 32] + 1] = False
    # contractions
    padded = np.append(code, [0, 0, 0])
    last = np.append(first, [True, True, True])
    mark = np.flatnonzero((code == 39) & start)
    mark = mark[~last[mark + 1]]
    for ending in CONTRACTIONS:
        fits = np.ones(len(mark), dtype=bool)
        for k, c in enumerate(ending):
            fits &= (padded[mark + 1 + k] == ord(c)) & ~last[mark + 1 + k]
        own = mark[fits]
        start[own + 1] = False
        after = own + 1 + len(ending)
        start[after[after < len(code)]] = True
    return start


@functools.cache
def encoder(path: str) -> "Encoder":
    """One for each Python worker: Spark runs one task after the other in it, so what it remembers serves them all."""
    return Encoder(path)


class Encoder:
    """Remembers the ids of distinct pieces and forgets them when they grow many.

    The pieces known are found by an open hash table: `slots` holds the index of a piece, or -1, at the low bits of its
    hash or the next free place after it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # pieces of a space and letters, end to end, could spell such a token
        self.spelt = any(all(c == " " or c.isalpha() for c in t) for t in self.added)
        size = self.tokenizer.get_vocab_size()
        # the byte-level alphabet spells a space so; in a piece of a space and letters only the first id begins with it
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self._clear()

    def _clear(self):
        self.slots = np.full(1 << 16, -1, dtype=np.int32)
        self.pieces = 0
        self.known = np.zeros(1 << 15, dtype=np.uint64)
        self.start = np.zeros(1 << 15, dtype=np.int64)
        self.count = np.zeros(1 << 15, dtype=np.int64)
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The index of the piece of each hash, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left, last = np.arange(len(hashes)), len(self.slots) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        while len(left):
            piece = self.slots[at]
            same = (piece >= 0) & (self.known[piece] == hashes[left])
            out[left[same]] = piece[same]
            on = (piece >= 0) & ~same
            left, at = left[on], at[on] + 1 & last
        return out

    def _place(self, pieces: np.ndarray):
        """Enters pieces that are in no slot yet."""
        last = len(self.slots) - 1
        at = (self.known[pieces] & np.uint64(last)).astype(np.int64)
        while len(pieces):
            free = self.slots[at] < 0
            self.slots[at[free]] = pieces[free]  # of several at one place one stays, the others go on
            on = self.slots[at] != pieces
            pieces, at = pieces[on], at[on] + 1 & last

    def _add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray):
        own = np.arange(self.pieces, self.pieces + len(hashes))
        self.pieces += len(hashes)
        while self.pieces > len(self.known):
            self.known, self.start, self.count = (np.append(x, np.zeros_like(x)) for x in (self.known, self.start, self.count))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        self.known[own] = hashes
        self.start[own] = self.used + np.cumsum(counts) - counts
        self.count[own] = counts
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        size = len(self.slots)
        while 2 * self.pieces > size:
            size *= 2
        if size > len(self.slots):
            self.slots = np.full(size, -1, dtype=np.int32)
            own = np.arange(self.pieces)
        self._place(own)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter(itertools.chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def _encode_pieces(self, pieces: list[str], joins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each piece.  Pieces of a space and letters (`joins`) are sent many to a text:
        each space begins a new piece, and the ids that begin with a space begin the pieces."""
        counts = np.zeros(len(pieces), dtype=np.int64)
        parts: list[np.ndarray] = [np.zeros(0, np.int32)] * 2
        for kind in (True, False):
            own = np.flatnonzero(joins == kind)
            if not len(own):
                continue
            texts = [pieces[k] for k in own.tolist()]
            if kind:
                groups = [texts[i : i + 256] for i in range(0, len(texts), 256)]
                texts = ["".join(g) for g in groups]
            found, sizes = self._library(texts)
            parts[kind] = found
            if not kind:
                counts[own] = sizes
                continue
            first = np.flatnonzero(self.spaced[found])
            ends = np.cumsum(sizes)
            begun = np.searchsorted(first, ends) - np.searchsorted(first, ends - sizes)
            if (begun != [len(g) for g in groups]).any():
                raise ValueError("pieces were cut in another way than the tokenizer does")
            counts[own] = np.diff(np.append(first, len(found)))
        out = np.zeros(int(counts.sum()), dtype=np.int32)
        at = np.cumsum(counts) - counts
        for kind in (True, False):
            own = joins == kind
            out[W.ragged(at[own], counts[own])] = parts[kind]
        return out, counts

    def _pieces(self, hashes: np.ndarray, spell) -> tuple[np.ndarray, np.ndarray]:
        """(start in the pool, number of ids) of distinct pieces."""
        if self.pieces > KEPT_PIECES:
            self._clear()
        found = self._find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            found[new] = np.arange(self.pieces, self.pieces + len(new))
            self._add(hashes[new], *self._encode_pieces(*spell(new)))
        return self.start[found], self.count[found]

    def _with_added(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Flags of the texts of a block that hold an added token."""
        out = np.zeros(len(bounds) - 1, dtype=bool)
        whole = data.tobytes()
        for token in map(str.encode, self.added):
            at = whole.find(token)
            while at >= 0:
                row = int(np.searchsorted(bounds, at, "right")) - 1
                out[row] |= at + len(token) <= bounds[row + 1]
                # the rest of a text that is known to hold one need not be looked at
                at = whole.find(token, int(bounds[row + 1]) if out[row] else at + 1)
        return out

    def block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds of ids) of the texts of a block."""
        rows = len(bounds) - 1
        table, values = _classes()
        code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a character
        at = np.searchsorted(heads, bounds)
        kinds = table[code]
        lengths = np.diff(at)
        odd = self._with_added(data, bounds)
        unsure = np.flatnonzero(kinds == UNSURE)
        odd[np.searchsorted(at, unsure, "right") - 1] = True
        if odd.any():
            keep = np.repeat(~odd, lengths)
            whole = [data[bounds[r] : bounds[r + 1]].tobytes().decode() for r in np.flatnonzero(odd)]
            code, kinds = code[keep], kinds[keep]
        own = np.append(0, np.cumsum(np.where(odd, 0, lengths)))
        counts = np.zeros(rows, dtype=np.int64)
        ids = np.zeros(0, dtype=np.int32)
        if len(code):
            start = np.flatnonzero(piece_starts(code, kinds, own[:-1][np.diff(own) > 0]))
            end = np.append(start[1:], len(code))
            distinct, first, which = W.coded(W.span_hashes(values[code], start, end))

            def spell(k):
                text = code.tobytes().decode("utf-32-le")
                a, b = start[first[k]], end[first[k]]
                joins = (code[a] == 32) & (kinds[np.minimum(a + 1, b - 1)] == LETTER) & (not self.spelt)
                return [text[i:j] for i, j in zip(a.tolist(), b.tolist())], joins

            place, size = self._pieces(distinct, spell)
            sizes = size[which]
            ids = self.pool[W.ragged(place[which], sizes)]
            before = np.append(0, np.cumsum(sizes))
            counts += np.diff(before[np.searchsorted(start, own)])
        if odd.any():
            more, more_counts = self._library(whole)
            plain = np.split(ids, np.cumsum(counts)[:-1])
            for r, part in zip(np.flatnonzero(odd), np.split(more, np.cumsum(more_counts)[:-1])):
                plain[r] = part
            counts[odd] = more_counts
            ids = np.concatenate(plain)
        return ids, np.append(0, np.cumsum(counts))

    def column(self, texts: pa.Array, end_id: int):
        """(first row, ids with `end_id` after each text, bounds) of the blocks of a column."""
        for row, bounds, data in W.blocks(texts, BLOCK_BYTES):
            ids, at = self.block(data, bounds)
            new = at + np.arange(len(at))
            out = np.full(new[-1], end_id, dtype=np.int32)
            keep = np.ones(len(out), dtype=bool)
            keep[new[1:] - 1] = False
            out[keep] = ids
            yield row, out, new
