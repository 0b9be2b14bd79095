"""SentencePiece encoding and decoding on the tokenizers library.

The model file is broadcast. Each task parses its protobuf wire format and rebuilds
normaliser, metaspace marker, scores (a unigram model, or the merges that a BPE model's
scores stand for) and byte fallback as a tokenizers pipeline. Tasks encode and decode
Arrow batches in slices of bounded size, with the library's own threads, and hold every
text against its round trip and, unless switched off, against SentencePiece itself.

Long texts are cut where a run of spaces begins. No piece reaches across such a place
(checked when the model is read), so the parts' ids joined are the ids of the whole. For the
same reason different words of a batch are encoded once each by a BPE model, and their ids
joined by array; decoding and SentencePiece get whole documents.

Defined cases: a null text has null ids and null decoded text and counts as right; an
empty text has no ids; repeated rows stay; an empty table gives an empty result; columns
outside ``keep`` are ignored, and kept ones should not bear the names of the results.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text that are encoded in one call, and the length at which a text is cut.
SLICE_BYTES, PART_CHARS = 1 << 18, 1 << 18
#: Characters whose words are taken together, words that are encoded as one line.
CHARS_AT_ONCE, WORDS_A_LINE = 1 << 22, 256

# Piece types and model types of the protobuf.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers for varints, bytes for the rest."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            if kind == 2:
                n, at = varint(at)
            elif kind in (1, 5):
                n = 8 if kind == 1 else 4
            else:
                raise ValueError(f"wire type {kind}")
            value = data[at : at + n]
            at += n
        yield key >> 3, value


def parse_model(data: bytes) -> dict:
    """Pieces (text, score, type), model type and normaliser settings of a model file."""
    pieces, model_type = [], UNIGRAM
    rules = {"charsmap": b"", "dummy_prefix": True, "squeeze": True, "escape": True}
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            model_type = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            spec = dict(fields(value))
            rules = {
                "charsmap": spec.get(2, b""),
                "dummy_prefix": bool(spec.get(3, 1)),
                "squeeze": bool(spec.get(4, 1)),
                "escape": bool(spec.get(5, 1)),
            }
    return {"pieces": pieces, "model_type": model_type} | rules


def merges_of(pieces) -> list[tuple[str, str]]:
    """Pairs to merge, in the order of the score of what they make."""
    usable = {t: s for t, s, kind in pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for text, score in usable.items():
        for cut in range(1, len(text)):
            if text[:cut] in usable and text[cut:] in usable:
                found.append((-score, text[:cut], text[cut:]))
    return [(a, b) for _, a, b in sorted(found, key=lambda x: x[0])]


def build(data: bytes):
    """(tokenizers.Tokenizer, settings) equivalent to the model file.

    A model whose normaliser only marks spaces is ``plain``: ``prepared`` puts on marker
    and dummy prefix, once for each text and not for each part, and the library gets no
    normaliser. Words are not split first: merging a line at once costs the library less
    than carrying its words through the pre-tokenizer.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse_model(data)
    pieces = model["pieces"]
    unk = next(i for i, p in enumerate(pieces) if p[2] == UNKNOWN)
    fallback = any(p[2] == BYTE for p in pieces)
    if model["model_type"] == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in pieces], unk_id=unk, byte_fallback=fallback)
    elif model["model_type"] == BPE:
        core = models.BPE(
            {t: i for i, (t, _, _) in enumerate(pieces)},
            merges_of(pieces),
            unk_token=pieces[unk][0],
            fuse_unk=True,
            byte_fallback=fallback,
            cache_capacity=0,  # whole lines hardly come twice
        )
    else:
        raise ValueError(f"model type {model['model_type']} is neither unigram nor BPE")
    out = Tokenizer(core)
    plain = not model["charsmap"] and not model["squeeze"]
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["squeeze"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model["dummy_prefix"] and not plain:
        steps.append(normalizers.Prepend(" "))
    if model["escape"] and not plain:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    words = [t for t, _, kind in pieces if kind in (NORMAL, USER_DEFINED, UNUSED)]
    apart = not any(a != MARK and b == MARK for t in words for a, b in zip(t, t[1:]))
    lines = fallback and not any("\n" in t for t in words)
    if lines:  # a line break is a byte piece of its own
        out.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
    out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
    return out, {
        "plain": plain,
        "cut": plain and apart and model["escape"],  # no piece goes on from a word into the spaces after it
        # the ids of each word can be told apart: a piece with the mark or a line break begins it
        "words": plain and apart and lines and model["escape"] and model["dummy_prefix"]
        and model["model_type"] == BPE and MARK in words,
        "prefix": model["dummy_prefix"] and plain,
        "mark": model["escape"] and plain,
        "strip": model["dummy_prefix"],
    }


def prepared(text: str, settings: dict) -> list[str]:
    """The parts of a text that are encoded one by one, dummy prefix included."""
    if not text:
        return []
    if settings["prefix"]:
        text = " " + text
    if settings["mark"]:
        text = text.replace(" ", MARK)
    if not settings["cut"] or len(text) <= PART_CHARS:
        return [text]
    parts, start = [], 0
    while len(text) - start > PART_CHARS:
        cut = text.find(MARK, start + PART_CHARS)
        while cut > 0 and text[cut - 1] == MARK:  # only where a run of spaces begins
            cut = text.find(MARK, cut + 1)
        if cut < 0:
            break
        parts.append(text[start:cut])
        start = cut
    return [*parts, text[start:]]


def encode_parts(tokenizer, settings: dict, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text, by calls of bounded size."""
    ids: list[list[np.ndarray]] = [[] for _ in texts]
    parts, owners, size = [], [], 0

    def flush():
        for owner, got in zip(owners, tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            ids[owner].append(np.array(got.ids, np.int32))

    for i, text in enumerate(texts):
        for part in prepared(text, settings):
            parts.append(part)
            owners.append(i)
            size += len(part)
            if size >= SLICE_BYTES:
                flush()
                parts, owners, size = [], [], 0
    if parts:
        flush()
    return [np.concatenate([np.zeros(0, np.int32), *x]) for x in ids]


def encode_words(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of different words end to end, and how many each has. A word begins with a line
    break or gets the mark in front."""
    forms = [w if w[:1] == "\n" else MARK + w for w in words]
    # a mark alone would run into the next word's
    lone = [i for i, form in enumerate(forms) if form == MARK]
    many = [form for form in forms if form != MARK]
    lines = ["".join(many[at : at + WORDS_A_LINE]) for at in range(0, len(many), WORDS_A_LINE)]
    got = [np.array(x.ids, np.int32) for x in tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
    ids = np.concatenate([np.zeros(0, np.int32), *got])
    seen, place = np.unique(ids, return_inverse=True)
    line_break = tokenizer.encode("\n", add_special_tokens=False).ids[0]
    begins = np.array([tokenizer.id_to_token(i).startswith(MARK) or i == line_break for i in seen.tolist()], bool)
    starts = np.flatnonzero(begins[place])
    if len(starts) != len(many):
        raise ValueError("words run into each other")
    sizes = np.diff(np.append(starts, len(ids)))
    for i in lone:
        at, alone = int(sizes[:i].sum()), tokenizer.encode(MARK, add_special_tokens=False).ids
        ids, sizes = np.insert(ids, at, alone), np.insert(sizes, i, len(alone))
    return ids, sizes


def encode_by_words(tokenizer, texts: list[str]) -> list[np.ndarray]:
    """Ids of texts without marks of their own and runs of spaces, different words encoded once."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n"), " ")
    found = lists.flatten().dictionary_encode()
    ids, sizes = encode_words(tokenizer, found.dictionary.to_pylist())
    begin, codes = np.cumsum(sizes) - sizes, found.indices.to_numpy()
    up_to = np.concatenate(([0], np.cumsum(sizes[codes])))
    joined = ids[np.repeat(begin[codes] - up_to[:-1], sizes[codes]) + np.arange(up_to[-1])]
    return np.split(joined, up_to[lists.offsets.to_numpy()[1:-1]])


def encode_arrays(tokenizer, settings: dict, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text. Words are taken of usual texts; empty ones, runs of spaces, marks and
    texts beyond ``PART_CHARS`` are encoded as they are."""
    usual = [
        settings["words"] and 0 < len(t) <= PART_CHARS and t[0] != " " and "  " not in t and MARK not in t for t in texts
    ]
    some = encode_by_words(tokenizer, [t for t, u in zip(texts, usual) if u]) if any(usual) else []
    rest = encode_parts(tokenizer, settings, [t for t, u in zip(texts, usual) if not u])
    some, rest = iter(some), iter(rest)
    return [next(some if u else rest) for u in usual]


def encode_texts(tokenizer, settings: dict, texts: list[str]) -> list[list[int]]:
    return [x.tolist() for x in encode_arrays(tokenizer, settings, texts)]


def bounded_slices(batch, chars: int) -> Iterator:
    """Slices of a batch whose last column has about so many bytes, or one row more."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // chars
    ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
    start = 0
    for end in ends.tolist():
        yield batch.slice(start, end - start)
        start = end


def decode_ids(tokenizer, settings: dict, ids: list[list[int]]) -> list[str]:
    texts = [t.replace(MARK, " ") for t in tokenizer.decode_batch(ids, skip_special_tokens=False)]
    return [t[1:] if settings["strip"] and t.startswith(" ") else t for t in texts]


def read_model(spark, path: str) -> bytes:
    """The model file: from the driver's disk, or by Spark where the path is a URI."""
    if "://" in path or path.startswith("file:"):
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    model: str = MODEL,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    threads: int = 2,
    verify: bool = True,
    with_decoded: bool = True,
) -> DataFrame:
    """One row per document: ``keep`` columns, ``ids``, ``n_tokens``, ``ids_crc32`` (of the
    ids as 32-bit little-endian), ``round_trip`` (decoding gives the normalised text back),
    ``parity`` (SentencePiece gives the same ids; null if not verified) and, unless left
    out, ``decoded``.
    """
    spark = docs.sparkSession
    data = read_model(spark, model)
    shared = spark.sparkContext.broadcast(data)

    def run(batches):
        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        tok, settings = build(shared.value)
        judge = None
        if verify:
            import sentencepiece

            judge = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            for rows in bounded_slices(batch, CHARS_AT_ONCE) if batch.num_rows else ():
                given = rows.column(rows.num_columns - 1).to_pylist()
                texts = [t or "" for t in given]
                arrays = encode_arrays(tok, settings, texts)
                ids = [x.tolist() for x in arrays]
                back = decode_ids(tok, settings, ids)
                null = [t is None for t in given]
                if judge is None:
                    same = [None] * len(texts)
                else:
                    same = [a == b for a, b in zip(ids, judge.encode(texts, num_threads=threads))]
                right = [
                    (d == t.replace(MARK, " ")) if settings["plain"] else None
                    for d, t in zip(back, texts)
                ]
                lengths = np.fromiter((len(x) for x in ids), np.int64, len(ids))
                flat = np.concatenate([np.zeros(0, np.int32), *arrays])
                ends = np.concatenate([[0], np.cumsum(lengths)])
                listed = pa.ListArray.from_arrays(
                    pa.array(ends.astype(np.int32)), pa.array(flat), mask=pa.array(null)
                )
                columns = [
                    listed,
                    pa.array(lengths),
                    pa.array(
                        [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])], pa.int64()
                    ),
                    pa.array(right, pa.bool_()),
                    pa.array(same, pa.bool_()),
                ]
                if with_decoded:
                    columns.append(
                        pa.array([None if n else d for n, d in zip(null, back)], pa.string())
                    )
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *columns], names=names)

    chosen = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("_text"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    made = ["ids array<int>", "n_tokens long", "ids_crc32 long", "round_trip boolean", "parity boolean"]
    made += ["decoded string"] if with_decoded else []
    names = [*keep, *(m.split()[0] for m in made)]
    return chosen.mapInArrow(run, ", ".join([*types, *made]))
