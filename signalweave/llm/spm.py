"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed here; normaliser, metaspace marker, scores, byte fallback and decoder are rebuilt as a
``tokenizers`` pipeline, for unigram and for BPE models. Batches are encoded by the library's threads. Ids are verified
against the sentencepiece library and decoded again: where no piece goes over a space, by distinct word and, for one text in
WHOLE, as the whole text; otherwise every text as a whole.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, read_table, text_or_empty, trim

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
#: Characters and texts of a batch given to the library at once, and threads of a worker.
BATCH_CHARS, BATCH_TEXTS, THREADS = 250_000, 10_000, 2
#: Characters whose distinct words are gathered together.
COLUMN_CHARS = 1_500_000
#: Bytes of words and their ids that are kept between batches.
KEPT_BYTES = 16_000_000
#: Of the texts that are encoded by words, one in so many (by a digest of its ids) is verified as a whole too.
WHOLE = 64


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        c = b[i]
        i += 1
        value |= (c & 127) << shift
        shift += 7
        if c < 128:
            return value, i


def wire(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of a protobuf message: integers as such, all else as bytes."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = b[i : i + n], i + n
        elif kind == 2:
            n, i = _varint(b, i)
            if i + n > len(b):
                raise ValueError("cut message")
            value, i = b[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


@dataclass(frozen=True)
class SpModel:
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    suffix_space: bool
    unk: int
    charsmap: bytes
    dummy_prefix: bool
    collapse: bool
    escape: bool


def parse_model(raw: bytes) -> SpModel:
    """Pieces and the settings that encoding depends on; absent fields have the format's defaults."""
    pieces, trainer, norm = [], {}, {}
    for number, value in wire(raw):
        if number == 1:
            d = dict(wire(value))
            pieces.append((d.get(1, b"").decode("utf-8"), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, _NORMAL)))
        elif number == 2:
            trainer = dict(wire(value))
        elif number == 3:
            norm = dict(wire(value))
    kind = trainer.get(3, UNIGRAM)
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    unk = next((i for i, p in enumerate(pieces) if p[2] == _UNKNOWN), 0)
    return SpModel(pieces, kind, bool(trainer.get(35, 0)), bool(trainer.get(24, 0)), unk, norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1)))


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best score of the whole first; of one whole, shorter left sides first."""
    score = {p: s for p, s, t in pieces if t in (_NORMAL, _USER, _UNUSED)}
    found = [(-s, i, k, p[:k], p[k:]) for i, (p, s, t) in enumerate(pieces) if t in (_NORMAL, _USER) for k in range(1, len(p)) if p[:k] in score and p[k:] in score]
    return [(a, b) for *_, a, b in sorted(found, key=lambda x: x[:3])]


def build(model: SpModel):
    """The ``tokenizers`` pipeline of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=model.unk, byte_fallback=model.byte_fallback)
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab=vocab, merges=merges_of(model.pieces), unk_token=model.pieces[model.unk][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    tok = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.collapse:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix and not model.suffix_space:
        steps.append(normalizers.Prepend(" "))
    if model.escape:
        steps.append(normalizers.Replace(" ", SPACE))
    tok.normalizer = normalizers.Sequence(steps)
    # No piece has a marker after another character, so texts can be cut before each run of markers; the library's cache then works by word.
    if model.kind == BPE and not any(SPACE in p.lstrip(SPACE) for p, _, t in model.pieces if t == _NORMAL):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    undo = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix and not model.suffix_space:
        undo.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(undo)
    return tok


_made: dict[str, tuple] = {}


def tokenizer_of(raw: bytes, threads: int = THREADS):
    """(pipeline, model) of a model file's bytes, once in a process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _made:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        model = parse_model(raw)
        _made[key] = (build(model), model)
    return _made[key]


def batches_of(texts: list[str], chars: int = BATCH_CHARS, most: int = BATCH_TEXTS) -> Iterator[list[str]]:
    """Consecutive texts, up to ``most``, of about ``chars`` characters together; a longer text is alone."""
    held: list[str] = []
    n = 0
    for t in texts:
        if held and (n + len(t) > chars or len(held) >= most):
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t)
    if held:
        yield held


class Codec:
    """Encodes and decodes texts, and verifies the rebuilt pipeline against the sentencepiece library.

    Where no piece goes over a space, words are encoded apart: each distinct word is encoded, verified and decoded once
    while it is kept, and a text's ids are its words' ids in order; one such text in WHOLE is also encoded, verified and
    decoded as a whole. Texts with runs of spaces, or with the marker itself, and other models are handled as whole texts.
    """

    def __init__(self, raw: bytes, verify: bool = True):
        self.tok, self.model = tokenizer_of(raw)
        m = self.model
        self.by_word = self.tok.pre_tokenizer is not None and m.byte_fallback and m.dummy_prefix and m.escape and not (m.suffix_space or m.charsmap or m.collapse)
        self.sp = None
        if verify:
            import sentencepiece

            self.sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.agrees, self.returns = np.empty(0, bool), np.empty(0, bool)

    def _known(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words among those kept; new ones are encoded, verified and decoded first."""
        if self.words.nbytes + self.ids.nbytes + self.starts.nbytes + self.sizes.nbytes > KEPT_BYTES:
            self._forget()
        number = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)
        unknown = number < 0
        new = words.filter(pa.array(unknown))
        number[unknown] = len(self.words) + np.arange(len(new))
        ids, ok, same = [], [self.agrees], [self.returns]
        for some in batches_of(new.to_pylist()):
            x, a, b = self.encode(some)
            ids += x
            ok.append(a)
            same.append(b)
        sizes = np.array([len(x) for x in ids], np.int64)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.int32)])
        self.agrees, self.returns = np.concatenate(ok), np.concatenate(same)
        self.words = pa.concat_arrays([self.words, new])
        return number

    def encode(self, texts: list[str]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Of each text: its ids, whether they agree with sentencepiece (true without verification), whether they decode to it."""
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        agree = [True] * len(ids) if self.sp is None else [a == b for a, b in zip(ids, self.sp.encode(texts, num_threads=THREADS), strict=True)]
        back = [a == b.replace(SPACE, " ") for a, b in zip(self.decode(ids), texts, strict=True)]
        return ids, np.array(agree, bool), np.array(back, bool)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's, agreement, round trip) of a string column without nulls."""
        n = len(texts)
        plain = np.zeros(n, bool)
        if self.by_word and n:
            odd = pc.or_(pc.match_substring_regex(texts, f"^ | $|  |{SPACE}"), pc.equal(texts, ""))
            plain = ~odd.to_numpy(zero_copy_only=False)
        parts: dict[int, np.ndarray] = {}
        agree, back = np.ones(n, bool), np.ones(n, bool)
        words = np.flatnonzero(plain)
        if len(words):
            ids, ends, ok, same = self._words(texts.take(pa.array(words)))
            agree[words], back[words] = ok, same
            if len(words) == n:
                return ids, ends, agree, back
            parts.update((int(i), ids[ends[k] : ends[k + 1]]) for k, i in enumerate(words))
        rest = np.flatnonzero(~plain)
        at = 0
        for some in batches_of(texts.take(pa.array(rest)).to_pylist()):
            ids, ok, same = self.encode(some)
            here = rest[at : at + len(some)]
            agree[here], back[here] = ok, same
            parts.update((int(i), np.array(x, np.int32)) for i, x in zip(here, ids, strict=True))
            at += len(some)
        arrays = [parts[i] for i in range(n)]
        return np.concatenate([np.empty(0, np.int32), *arrays]), np.cumsum([0, *map(len, arrays)]), agree, back

    def verify_whole(self, texts: pa.Array, ids: np.ndarray, ends: np.ndarray, agree: np.ndarray, back: np.ndarray, rows: list[int]) -> None:
        """Encodes ``rows`` as whole texts; where ids differ from those given, ``agree`` and ``back`` turn false."""
        at = 0
        for some in batches_of(texts.take(pa.array(rows, pa.int64())).to_pylist()):
            whole, ok, same = self.encode(some)
            for k, x in enumerate(whole):
                i = rows[at + k]
                equal = np.array_equal(ids[ends[i] : ends[i + 1]], np.array(x, np.int32))
                agree[i] &= equal and ok[k]
                back[i] &= equal and same[k]
            at += len(some)

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        number = self._known(coded.dictionary)
        flat, starts, sizes, good_ids, good_text = self.ids, self.starts, self.sizes, self.agrees, self.returns
        index = number[index]
        each = sizes[index]
        before = np.cumsum(each) - each
        out = flat[np.arange(int(each.sum())) + np.repeat(starts[index] - before, each)]
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ends = np.append(before, len(out))[bounds]
        fails = lambda good: np.diff(np.append(0, np.cumsum(~good[index]))[bounds]) == 0
        return out, ends, fails(good_ids), fails(good_text)


def _encoded(raw: bytes, keep_ids: bool, verify: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_()), ("parity", pa.bool_()), *([("ids", pa.list_(pa.int32()))] if keep_ids else [])])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(raw, verify)
        for batch in batches:
            # Slices of about COLUMN_CHARS characters, so that memory does not depend on how long the texts are.
            total = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = [0, *(np.flatnonzero(np.diff(total // COLUMN_CHARS)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                texts = batch.column(1).slice(lo, hi - lo)
                ids, ends, agree, back = codec.encode_column(texts)
                raw_ids = ids.astype("<i4", copy=False)
                digests = [hashlib.sha256(raw_ids[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
                if verify and codec.by_word:
                    codec.verify_whole(texts, ids, ends, agree, back, [i for i, d in enumerate(digests) if d.digest()[0] % WHOLE == 0])
                cols = [
                    batch.column(0).slice(lo, hi - lo),
                    pc.utf8_length(texts).cast(pa.int64()),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array([d.hexdigest() for d in digests]),
                    pa.array(back),
                    pa.array(agree),
                ]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False))))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)
            trim()

    return run


def sp_encode(docs: DataFrame, model_path: str = MODEL, keep_ids: bool = True, verify: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, n_tokens, ids_sha256, round_trip, parity, and the ids if asked for.

    ids_sha256 is of the ids as little-endian 32-bit integers. ``parity`` and ``round_trip`` are verified as ``Codec`` says:
    by distinct words, and by whole texts for one text in WHOLE and for all that words can't be encoded apart. Null texts count as empty, and empty texts have no tokens.
    The model file is read by the driver and sent with the task; executors need the libraries only. Other columns are
    not read. No shuffle: texts are encoded where they are read.
    """
    with open(model_path, "rb") as f:
        raw = f.read()
    ddl = "doc_id long, n_chars long, n_tokens long, ids_sha256 string, round_trip boolean, parity boolean" + ", ids array<int>" * keep_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lean(_encoded(raw, keep_ids, verify)), ddl)


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return sp_encode(read_table(spark, sf_dir, "documents"), keep_ids=False)
