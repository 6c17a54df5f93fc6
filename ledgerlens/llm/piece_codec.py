"""Exact encoding and decoding with a merge-type SentencePiece model.

Merge-type encoding repeatedly joins the neighbouring pair whose joint piece
has the best score, the leftmost of equals. A sequence of pieces is that
encoding exactly if each adjacent pair, merged anew on its own, comes out as
the same two pieces: merges inside two neighbours happen in the same order
with or without the rest of the text, so the first merge across a border in
the whole text is also one in the pair. The encoder relies on this and never
runs the merge over a whole text:

* an Aho-Corasick automaton finds the longest piece at each position,
* that piece is taken if it is compatible with the piece before it, else the
  next shorter piece that is a prefix of it is tried,
* with none left, the position is marked in a bit field of failed positions
  and the encoder steps back. The pieces up to a position are the only
  encoding of the text up to it, so a failed position never needs a second
  visit.

Compatibility is decided by re-merging the two pieces (cached per pair).
Characters without a piece become the pieces of their UTF-8 bytes and are
borders no merge crosses. No piece holds a space mark behind another character
either, so texts are cut in front of each run of space marks. The distinct
parts of a batch that a bounded cache does not hold are encoded together, each
step of the search being taken for all of them at once in numpy. The space mark
is written as a plain space throughout. Decoding gathers the bytes of the ids'
pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import text_chunks

MARK = "▁"
#: Parts in a generation of the cache; two generations are held.
CACHE = 100_000
#: Slots for pair checks; a slot holds one pair, a newer one replaces it.
PAIR_SLOTS = 1 << 20
#: Parts that are encoded together, and parts times the length of the longest.
TOGETHER, CELLS = 8_192, 1 << 20


def unsupported(settings) -> list[str]:
    """What in a model's settings (a parsed model file) ``Codec`` would not
    follow; empty for models that it encodes exactly."""
    trainer, normalizer = settings.trainer_spec, settings.normalizer_spec
    kinds = {p.type for p in settings.pieces}
    checks = {
        "its type is not BPE": trainer.model_type != trainer.BPE,
        "it normalises text": len(normalizer.precompiled_charsmap) > 0,
        "it adds no dummy prefix": not normalizer.add_dummy_prefix,
        "it removes extra white space": normalizer.remove_extra_whitespaces,
        "it does not escape white space": not normalizer.escape_whitespaces,
        "it treats white space as a suffix": trainer.treat_whitespace_as_suffix,
        "it denormalises what it decodes": len(settings.denormalizer_spec.precompiled_charsmap) > 0,
        "it has user-defined pieces": settings.SentencePiece.USER_DEFINED in kinds,
        "it has unused pieces": settings.SentencePiece.UNUSED in kinds,
    }
    return [what for what, holds in checks.items() if holds]


def read_vocabulary(model_path: str) -> dict:
    """Pieces, scores and kinds of a model file (at most its size: some
    hundred KB), for ``Codec``; tasks get it instead of the path. A model that
    the codec cannot encode exactly is an error."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    settings = sentencepiece_model_pb2.ModelProto()
    settings.ParseFromString(sp.serialized_model_proto())
    if wrong := unsupported(settings):
        raise ValueError(f"{model_path}: " + ", ".join(wrong))
    n = sp.get_piece_size()
    kinds = ["byte" if sp.is_byte(i) else "control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "piece" for i in range(n)]
    return {"pieces": [sp.id_to_piece(i) for i in range(n)], "scores": [sp.get_score(i) for i in range(n)], "kinds": kinds, "end": sp.eos_id()}


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, vocabulary: dict):
        self.end, self.scores = vocabulary["end"], vocabulary["scores"]
        kinds = vocabulary["kinds"]
        self.text = [p.replace(MARK, " ") for p in vocabulary["pieces"]]
        self.ids = {self.text[i]: i for i, k in enumerate(kinds) if k == "piece"}
        self.sizes = [len(p) for p in self.text]
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece holds a space mark behind another character")
        self.byte_ids = np.zeros(256, np.int32)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_ids[int(self.text[i][3:-1], 16)] = i
        raw = [
            b"" if k == "control" else bytes([int(p[3:-1], 16)]) if k == "byte" else " ⁇ ".encode() if k == "unknown" else p.encode()
            for p, k in zip(self.text, kinds, strict=True)
        ]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.length) - self.length
        self.spaced = np.array([r[:1] == b" " and k != "unknown" for r, k in zip(raw, kinds, strict=True)])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        #: Stands for a character without a piece.
        self.no_piece = len(kinds)
        self.sizes = np.array([len(p) for p in self.text] + [1])
        self.shorter = np.full(len(kinds) + 1, -1)  # the longest piece that is a proper prefix of a piece
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
        self.pair_keys = np.full(PAIR_SLOTS, -1)
        self.pair_ok = np.zeros(PAIR_SLOTS, bool)
        self.cut = re.compile(" +[^ ]*").findall
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Merge-type encoding by definition, for short strings."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether pairs of adjacent pieces come out of re-merging as they
        are; ``before`` is -1 at a border."""
        key = (before + 1) << 20 | piece
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 20)).astype(np.int64) % PAIR_SLOTS
        free = piece == self.no_piece
        new = np.flatnonzero((self.pair_keys[slot] != key) & ~free)
        ok = self.pair_ok[slot] | free
        if len(new):
            _, at, back = np.unique(key[new], return_index=True, return_inverse=True)
            told = []
            for b, p in zip(before[new][at].tolist(), piece[new][at].tolist()):
                want = [self.text[p]] if b < 0 else [self.text[b], self.text[p]]
                told.append(self.merged("".join(want)) == want)
            told = np.array(told)[back]
            ok[new] = told
            self.pair_keys[slot[new]] = key[new]
            self.pair_ok[slot[new]] = told
            # two pairs of one slot: the later stays, and its answer with it
            same = self.pair_keys[slot[new]] == key[new]
            self.pair_ok[slot[new][same]] = told[same]
        return ok

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """32-bit ids of parts, by backtracking on all of them in step."""
        text = "".join(parts)
        sizes, shorter, none = self.sizes, self.shorter, self.no_piece
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64)
        ends, pieces = found[::2], found[1::2]
        longest = np.full(len(text) + 1, none)
        longest[ends + 1 - sizes[pieces]] = pieces  # ends ascend, so the longest stays
        failed = np.zeros(len(text) + 1, bool)
        n = np.array([len(p) for p in parts])
        stop = np.cumsum(n)
        pos = stop - n
        depth = np.zeros(len(parts), np.int64)
        before = np.full(len(parts), -1)
        piece = longest[pos]
        out = np.zeros((len(parts), int(n.max(initial=0)) + 1), np.int32)
        live = np.flatnonzero(n)
        while len(live):
            p, at = piece[live], pos[live]
            to = at + sizes[p]
            good = (p >= 0) & (to <= stop[live])  # a part of spaces runs into the next
            good[good] = ~failed[to[good]]
            good[good] = self.compatible(before[live[good]], p[good])
            go = live[good]
            out[go, depth[go]] = p[good]
            depth[go] += 1
            pos[go] = to[good]
            before[go] = np.where(p[good] == none, -1, p[good])
            piece[go] = longest[to[good]]
            other = ~good & (p >= 0)
            piece[live[other]] = shorter[p[other]]
            # none is left here: mark the place as failed, step back
            back = live[p < 0]
            if len(back):
                failed[pos[back]] = True
                depth[back] -= 1
                last = out[back, depth[back]].astype(np.int64)
                pos[back] -= sizes[last]
                piece[back] = shorter[last]
                prior = np.where(depth[back] > 0, out[back, depth[back] - 1].astype(np.int64), -1)
                before[back] = np.where(prior == none, -1, prior)
            live = live[pos[live] < stop[live]]
        made = []
        odd = set(np.flatnonzero((out == none).any(1)).tolist())
        for k, (d, row) in enumerate(zip(depth.tolist(), out)):
            if k in odd:
                made.append(self._with_bytes(parts[k], row[:d]))
            else:
                made.append(row[:d].tobytes())
        return made

    def _with_bytes(self, part: str, ids: np.ndarray) -> bytes:
        out, at = [], 0
        for i in ids.tolist():
            if i == self.no_piece:
                out += [self.byte_ids[x] for x in part[at].encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
            at += int(self.sizes[i])
        return np.array(out, np.int32).tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """32-bit ids of texts, without the end id."""
        split = []
        for t in texts:
            if MARK in t:
                t = t.replace(MARK, " ")
            # a part without a space in front has exactly one
            split.append([] if not t else self.cut(" " + t) if t[0] == " " or "  " in t else t.split(" "))
        if len(self.cache) > CACHE:
            self.older, self.cache = self.cache, {}
        cache, older = self.cache, self.older
        new = []
        for w in set(chain.from_iterable(split)):
            if w not in cache:
                if w in older:
                    cache[w] = older[w]
                else:
                    new.append(w)
        new.sort(key=len)  # parts of like length end their search together
        while new:
            # the longest left, and as many others as fit
            some = new[-max(1, min(TOGETHER, CELLS // (len(new[-1]) + 1))) :]
            del new[-len(some) :]
            cache.update(zip(some, self.encode_parts([w if w[:1] == " " else " " + w for w in some])))
        return [b"".join(map(cache.__getitem__, words)) for words in split]

    def encode(self, text: str, end: bool = True) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist() + [self.end] * end

    def decode_all(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids lie between the offsets."""
        size, start = self.length[ids], self.start[ids]
        # a text's first space mark is not part of it; control pieces before it are nothing
        some = np.flatnonzero(size)
        at = np.searchsorted(some, offs[:-1])
        first = some[np.minimum(at, len(some) - 1)] if len(some) else some
        first = first[(at < len(some)) & (first < offs[1:])] if len(some) else some
        lead = first[self.spaced[ids[first]]]
        size[lead] -= 1
        start[lead] += 1
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.blob[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])], ends[offs]

    def decode(self, ids: list[int]) -> str:
        data, _ = self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))
        return data.tobytes().decode("utf-8", "replace")


def encode_and_decode(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``ids`` (array of int, the end id last) and
    ``decoded`` (the text those ids decode to).

    A null or empty text has the end id alone and decodes to the empty text.
    Each row is handled by itself, so repeated rows and clashing other columns
    make no difference; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the size of the model file
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        end = np.int32(codec.end).tobytes()
        for batch in batches:
            for a, b, data, offs in text_chunks(batch.column(1)):
                raw, offs = data.tobytes(), offs.tolist()
                coded = codec.encode_all([raw[x:y].decode("utf-8", "replace") for x, y in zip(offs, offs[1:])])
                ids = np.frombuffer(end.join([*coded, b""]), np.int32)
                ends = np.cumsum([0, *(len(c) // 4 + 1 for c in coded)])
                text, text_ends = codec.decode_all(ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        pa.StringArray.from_buffers(b - a, pa.py_buffer(text_ends.astype(np.int32)), pa.py_buffer(text)),
                    ],
                    names=[id_col, "ids", "decoded"],
                )

    rows = docs.select(docs[id_col], docs[text_col])
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>, decoded string")
