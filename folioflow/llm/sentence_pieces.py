"""SentencePiece encoding and decoding in batched numpy.

Texts are cut into segments that no piece crosses (before each run of the
word mark, and around line ends), and only segments that a worker has not met
yet are encoded, all those of one length together:

* **Viterbi** (``viterbi``): the words advance together from character to
  character.  Hashes of all their substrings of a length are probed in the
  sorted hashes of the pieces of that length; the best score at each place is
  a maximum over the piece lengths, and the length taken is the backpointer.
* **Merges** (``merge``): for files of the merge type, whose own ids are
  defined by merge order and not by a best path.  In each step every word
  merges its best pair (the first of equals), found among the sorted pairs of
  pieces that join to a piece.

A merge file holds ranks instead of log-probabilities; its pieces then cost
``log(rank + 2)`` in Viterbi (Zipf's law).  Characters that no piece covers
become byte pieces.  Decoding joins the pieces' bytes.

Defined results: NULL text counts as empty and gives no ids; repeated rows
are alike; a text with the word mark itself decodes with a space in its place
(as the format has it), which ``round_trip`` shows.  Whole texts are read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from folioflow.llm.batches import groups, map_columns, pick

MARK = "▁"
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)
CACHE_BYTES = 160_000_000  # what each of the two generations of the cache may hold, besides the texts of one group
ENTRY_BYTES = 320  # of a short segment and its ids, besides their lengths
SIEVE_BITS = 18  # hashes are looked up only if a bit table of this size has them
CELLS = 500_000  # characters of equal-length segments that advance together
PAIR_MIX = 2_654_435_761
LONG = 64  # above this many characters a segment merges by a heap of its own


def _field(raw: bytes, wanted: int) -> list:
    """Values of a field of a serialised message (varints and byte strings)."""
    out, at = [], 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            size = varint()
            value = raw[at : at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            value = raw[at : at + size]
            at += size
        if key >> 3 == wanted:
            out.append(value)
    return out


class Ids:
    """Ids of many segments, one after another, with the place of each."""

    def __init__(self) -> None:
        self.flat = np.zeros(0, dtype="<u4")
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def add(self, raw: list[bytes]) -> None:
        length = np.array([len(r) for r in raw], dtype=np.int64) // 4
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(raw), dtype="<u4")])

    def join(self, places: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The ids of texts, given the places of all their segments and where each text's end."""
        length = self.length[places]
        behind = np.cumsum(length)
        at = np.arange(behind[-1] if len(behind) else 0) + np.repeat(self.start[places] - (behind - length), length)
        raw = self.flat[at].tobytes()
        stops = (np.concatenate([[0], behind])[ends] * 4).tolist()
        return [raw[lo:hi] for lo, hi in zip([0, *stops], stops)]


class Segments(dict):
    """Numbers of the segments met so far, in order; a new one gets the next number and waits for its ids."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[str] = []
        self.best: list[bytes] = []  # Viterbi ids
        self.own: list[bytes] = []  # the file's own ids
        self.best_ids, self.own_ids = Ids(), Ids()
        self.held = 0

    def __missing__(self, segment: str) -> int:
        self[segment] = n = len(self.names)
        self.names.append(segment)
        self.held += ENTRY_BYTES + 12 * len(segment)
        return n

    def fill(self, pairs: list[tuple[bytes, bytes]]) -> None:
        if pairs:
            best, own = zip(*pairs)
            self.best += best
            self.own += own
            self.best_ids.add(best)
            self.own_ids.add(own)


class PieceModel:
    """The pieces of a model file, and segments encoded so far."""

    _open: dict[str, PieceModel] = {}

    @classmethod
    def open(cls, path: str) -> PieceModel:
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sp.serialized_model_proto()
        trainer = (_field(proto, 2) or [b""])[-1]
        normalizer = (_field(proto, 3) or [b""])[-1]
        self.merges = (_field(trainer, 3) or [1])[-1] == 2
        self.dummy_prefix = bool((_field(normalizer, 3) or [1])[-1])
        if any(_field(normalizer, 2)) or (_field(normalizer, 4) or [1])[-1]:
            raise ValueError("a model whose normaliser changes the text is not supported")
        size = sp.get_piece_size()
        self.bytes_of: list[bytes] = []
        byte_ids = np.full(256, sp.unk_id(), dtype=np.int64)
        texts: list[tuple[str, int]] = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"" if sp.is_control(i) else b" \xe2\x81\x87 ")
            else:
                texts.append((piece, i))
                self.bytes_of.append(piece.encode("utf-8"))
        self.byte_ids = byte_ids
        self.byte_flat = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.byte_length = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.byte_start = np.cumsum(self.byte_length) - self.byte_length
        self.score = np.array([sp.get_score(i) for i in range(size)])
        if self.merges:
            self.price = -np.log(np.maximum(-self.score, 0.0) + 2.0)
        else:
            self.price = self.score.copy()
        self.unknown_price = float(min(self.price[i] for _, i in texts)) - 10.0
        self.longest = max(len(p) for p, _ in texts)
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in texts)
        self.line_ends = not any("\n" in p for p, _ in texts)
        self.id_of = dict(texts)
        self._index(texts)
        # signs that no piece has behind a letter: a word and the signs after it are encoded apart
        joined = {b for p, _ in texts for a, b in zip(p, p[1:]) if a.isalpha()}
        self.signs = "".join(c for c in ".,!?;:*$%&#|)" if c not in joined)
        self.met = Segments()
        self.older = Segments()

    def _index(self, texts: list[tuple[str, int]]) -> None:
        """Sorted hashes of the pieces of each length, and of the pairs that join to a piece."""
        self.keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_length: dict[int, list[tuple[str, int]]] = {}
        for piece, i in texts:
            by_length.setdefault(len(piece), []).append((piece, i))
        for length, members in by_length.items():
            points = np.array([[ord(c) for c in p] for p, _ in members], dtype=np.int64)
            hashes = self._extend(points, length)[-1][:, 0]
            order = np.argsort(hashes)
            sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
            sieve[hashes & ((1 << SIEVE_BITS) - 1)] = True
            self.keys[length] = (hashes[order], np.array([i for _, i in members], dtype=np.int64)[order], sieve)
        pairs: dict[int, int] = {}
        size = len(self.bytes_of)
        for piece, i in texts:
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = i
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.pair_sieve = np.zeros(1 << (SIEVE_BITS + 2), dtype=bool)
        self.pair_sieve[(self.pair_keys * PAIR_MIX >> 20) & (len(self.pair_sieve) - 1)] = True

    @staticmethod
    def _extend(points: np.ndarray, longest: int) -> list[np.ndarray]:
        """For each length, the hashes of the substrings that start at each place."""
        out = []
        states: list[np.ndarray] = []
        for length in range(1, longest + 1):
            width = points.shape[1] - length + 1
            if width < 1:
                break
            last = points[:, length - 1 :] + 1
            if not states:
                states = [last % p for p in PRIMES]
            else:
                states = [(s[:, :width] * b + last) % p for s, b, p in zip(states, BASES, PRIMES)]
            out.append(states[0] << 31 | states[1])
        return out

    def _probe(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        if length not in self.keys:
            return np.full(hashes.shape, -1, dtype=np.int64)
        keys, ids, sieve = self.keys[length]
        out = np.full(hashes.shape, -1, dtype=np.int64)
        likely = np.nonzero(sieve[hashes & (len(sieve) - 1)])
        wanted = hashes[likely]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        out[likely] = np.where(keys[at] == wanted, ids[at], -1)
        return out

    # -- segments ------------------------------------------------------------

    def segments(self, text: str) -> list[str]:
        """Parts of the normalised text that no piece crosses."""
        if not text:
            return []
        lead = MARK if self.dummy_prefix else ""
        if not self.splits:
            return [lead + text.replace(" ", MARK)]
        if self.line_ends and "\x00" not in text and "  " not in text and text[0] != " " and MARK not in text:
            whole = lead + text.replace(" ", "\x00" + MARK).replace("\n", "\x00\n\x00")
            return [s for s in whole.split("\x00") if s]
        return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", lead + text.replace(" ", MARK))

    def encode_new(self) -> None:
        """Encode the segments met since the last call."""
        met, older = self.met, self.older
        found: dict[str, tuple[bytes, bytes]] = {}
        single: list[str] = []
        apart: dict[str, tuple[str, str]] = {}
        at = len(met.best)
        while at < len(met.names):  # grows: a word and the signs after it are segments of their own
            s = met.names[at]
            at += 1
            if s in older:
                found[s] = (older.best[older[s]], older.own[older[s]])
                continue
            word = s.rstrip(self.signs)
            if len(word) < len(s) and word and word[-1].isalpha():
                apart[s] = (word, s[len(word) :])
                met[word], met[s[len(word) :]]
            else:
                single.append(s)
        by_length: dict[int, list[str]] = {}
        for s in single:
            by_length.setdefault(len(s), []).append(s)
        for length, words in by_length.items():
            step = max(1, CELLS // length)
            for lo in range(0, len(words), step):
                part = words[lo : lo + step]
                points = np.frombuffer("".join(part).encode("utf-32-le"), dtype=np.uint32).astype(np.int64).reshape(len(part), length)
                best = self.viterbi(points, part)
                own = (self.merge(points, part) if length <= LONG else [self._merge_long(w) for w in part]) if self.merges else best
                found.update(zip(part, zip(best, own)))
        for s, pair in apart.items():
            (a, b), (c, d) = ((found.get(x) or (met.best[met[x]], met.own[met[x]])) for x in pair)
            found[s] = (a + c, b + d)
        met.fill([found[s] for s in met.names[len(met.best) :]])

    def _bytes(self, word: str) -> list[int]:
        return self.byte_ids[np.frombuffer(word.encode("utf-8"), dtype=np.uint8)].tolist()

    def viterbi(self, points: np.ndarray, words: list[str]) -> list[bytes]:
        """Best-scoring pieces of words of one length (a row of code points each)."""
        m, n = points.shape
        longest = min(self.longest, n)
        found = [self._probe(h, k + 1) for k, h in enumerate(self._extend(points, longest))]
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0.0
        back = np.ones((n + 1, m), dtype=np.int64)
        for end in range(1, n + 1):
            options = np.full((min(longest, end), m), -np.inf)
            for length in range(1, len(options) + 1):
                ids = found[length - 1][:, end - length]
                price = np.where(ids >= 0, self.price[ids], self.unknown_price if length == 1 else -np.inf)
                options[length - 1] = best[end - length] + price
            top = len(options) - 1 - np.argmax(options[::-1], axis=0)  # the longest of equals
            best[end] = options[top, np.arange(m)]
            back[end] = top + 1
        # walk back all words together; a word that has arrived waits
        at = np.full(m, n)
        rows = np.arange(m)
        lengths, starts = [], []
        while at.any():
            taken = np.where(at > 0, back[at, rows], 0)
            at = at - taken
            lengths.append(taken)
            starts.append(at.copy())
        table = np.stack([np.where(t > 0, self._piece_at(found, t, s, rows), -2) for t, s in zip(lengths, starts)])[::-1]
        spans = np.stack(starts)[::-1]
        return self._pack(table.T, spans.T, words)

    @staticmethod
    def _piece_at(found: list[np.ndarray], taken: np.ndarray, start: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), -1, dtype=np.int64)
        for length in np.unique(taken):
            if length:
                hit = np.flatnonzero(taken == length)
                out[hit] = found[length - 1][rows[hit], start[hit]]
        return out

    def _pack(self, ids: np.ndarray, starts: np.ndarray, words: list[str]) -> list[bytes]:
        """Rows of ids (-2: nothing, -1: a character without a piece, by its start) as bytes."""
        kept = ids != -2
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1) * 4).tolist()
        out = [flat[lo:hi] for lo, hi in zip([0, *ends], ends)]
        for k in np.flatnonzero((ids == -1).any(axis=1)).tolist():
            full: list[int] = []
            for i, s in zip(ids[k][kept[k]].tolist(), starts[k][kept[k]].tolist()):
                full += [i] if i >= 0 else self._bytes(words[k][s])
            out[k] = np.array(full, dtype="<u4").tobytes()
        return out

    def merge(self, points: np.ndarray, words: list[str]) -> list[bytes]:
        """Merge order of words of one length: each step joins the best pair of each word."""
        m, n = points.shape
        ids = self._probe(self._extend(points, 1)[0], 1)
        starts = np.broadcast_to(np.arange(n), (m, n)).copy()
        out: list[bytes] = [b""] * m
        rows = np.arange(m)
        joined = self._joined(ids[:, :-1], ids[:, 1:])  # the piece that each pair makes
        score = np.where(joined >= 0, self.score[joined], -np.inf)
        while True:
            width = ids.shape[1]
            if width > 1:
                pick_at = np.argmax(score, axis=1)  # the first of equals
                live = np.isfinite(score[np.arange(len(ids)), pick_at])
            else:
                live = np.zeros(len(ids), dtype=bool)
            done = np.flatnonzero(~live)
            if len(done):
                for k, raw in zip(rows[done], self._pack(ids[done], starts[done], [words[r] for r in rows[done]])):
                    out[k] = raw
            if not live.any():
                return out
            ids, starts, rows, joined, score, pick_at = (x[live] for x in (ids, starts, rows, joined, score, pick_at))
            every = np.arange(len(ids))
            ids[every, pick_at] = joined[every, pick_at]
            keep = np.arange(width)[None, :] != (pick_at + 1)[:, None]  # drop the right half of each pair
            ids = ids[keep].reshape(len(ids), width - 1)
            starts = starts[keep].reshape(len(starts), width - 1)
            keep = np.arange(width - 1)[None, :] != pick_at[:, None]  # and the pair itself
            joined = joined[keep].reshape(len(ids), width - 2)
            score = score[keep].reshape(len(ids), width - 2)
            for shift in (-1, 0):  # only the pairs beside the new piece have changed
                at = pick_at + shift
                some = np.flatnonzero((at >= 0) & (at < width - 2))
                place = at[some]
                piece = self._joined(ids[some, place], ids[some, place + 1])
                joined[some, place] = piece
                score[some, place] = np.where(piece >= 0, self.score[piece], -np.inf)

    def _joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two neighbouring pieces join to, -1 where there is none."""
        out = np.full(a.shape, -1, dtype=np.int64)
        key = np.where((a >= 0) & (b >= 0), a * len(self.bytes_of) + b, 0)
        likely = np.nonzero(self.pair_sieve[(key * PAIR_MIX >> 20) & (len(self.pair_sieve) - 1)])
        wanted = key[likely]
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        out[likely] = np.where(self.pair_keys[at] == wanted, self.pair_ids[at], -1)
        return out

    def _merge_long(self, word: str) -> bytes:
        """Merge order of one long segment, by a heap of its pairs."""
        text = list(word)
        right = list(range(1, len(text) + 1))
        left = list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < len(text):
                both = text[i] + text[j]
                if both in self.id_of:
                    heapq.heappush(heap, (-self.score[self.id_of[both]], i, both))

        for i in range(len(text)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i]
            if text[i] and j < len(text) and text[i] + text[j] == both:
                text[i], text[j] = both, ""
                right[i] = right[j]
                if right[i] < len(text):
                    left[right[i]] = i
                offer(i)
                if left[i] >= 0:
                    offer(left[i])
        full: list[int] = []
        for t in text:
            if t:
                full += [self.id_of[t]] if t in self.id_of else self._bytes(t)
        return np.array(full, dtype="<u4").tobytes()

    # -- texts ---------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(Viterbi ids, the file's own ids) of each text, as unsigned 32-bit little-endian bytes."""
        if self.met.held > CACHE_BYTES:
            self.older, self.met = self.met, Segments()
        parts = [self.segments(t) for t in texts]
        places = np.array(list(map(self.met.__getitem__, chain.from_iterable(parts))), dtype=np.int64)
        self.encode_new()
        ends = np.cumsum([len(p) for p in parts])
        return list(zip(*(ids.join(places, ends) for ids in (self.met.best_ids, self.met.own_ids))))

    def decode(self, ids: bytes) -> str:
        """The text of ids."""
        places = np.frombuffer(ids, dtype="<u4")
        length = self.byte_length[places]
        behind = np.cumsum(length)
        at = np.arange(behind[-1] if len(behind) else 0) + np.repeat(self.byte_start[places] - (behind - length), length)
        text = self.byte_flat[at].tobytes().decode("utf-8", errors="replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def model_path(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public model file."""
    import public_tokenizers

    return public_tokenizers.path(name)


SCHEMA = {
    "doc_id": "long",
    "n_ids": "long",
    "ids_crc32": "long",
    "round_trip": "boolean",
    "viterbi_n_ids": "long",
    "viterbi_ids_crc32": "long",
    "viterbi_round_trip": "boolean",
}


def encode_pieces(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """Ids of each row of ``docs`` (``doc_id``, ``text``), their checksums, and whether they decode to the text.

    ``ids=True`` also returns the ids themselves, as bytes.
    """
    place = path or model_path()
    schema = SCHEMA | ({"ids": "binary", "viterbi_ids": "binary"} if ids else {})

    def start():
        model = PieceModel.open(place)

        def work(cols):
            texts = [t or "" for t in cols["text"]]
            out = {n: [] for n in schema}
            out["doc_id"] = cols["doc_id"]
            for lo, hi in groups(texts):
                part = texts[lo:hi]
                for text, (best, own) in zip(part, model.encode(part)):
                    for prefix, raw in (("", own), ("viterbi_", best)):
                        out[f"{prefix}n_ids"].append(len(raw) // 4)
                        out[f"{prefix}ids_crc32"].append(zlib.crc32(raw))
                        out[f"{prefix}round_trip"].append(model.decode(raw) == text)
                        if ids:
                            out[f"{prefix}ids"].append(raw)
            return out

        return work

    return map_columns(pick(docs, doc_id="long", text="string"), schema, start)


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(``doc_id``, ``text``) from rows of (``doc_id``, ``ids``)."""
    place = path or model_path()

    def start():
        model = PieceModel.open(place)
        return lambda cols: {"doc_id": cols["doc_id"], "text": [model.decode(b or b"") for b in cols["ids"]]}

    return map_columns(pick(encoded, doc_id="long", ids="binary"), {"doc_id": "long", "text": "string"}, start)
