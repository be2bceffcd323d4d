"""Operator 12: BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last ``WINDOW`` bytes cuts texts where its value says
so, so equal passages are cut alike wherever they stand.  Each distinct chunk
of all documents is encoded once: chunks are dealt by a 128-bit digest to
buckets, one task reads a bucket and encodes a chunk when it first comes, and
every batch of documents that has the chunk gets its tokens.  A batch asks once
for a chunk, however many of its documents hold it.

A cut falls inside words, and tokens there would be wrong.  Of a chunk only
what lies between its first and its last blank is encoded as such; the word at
the join is encoded anew, together with its neighbours: if the tokens of the
three words together are those of the word and of its two neighbours alone,
the join agrees with both sides.  Where they don't agree, or a chunk has no
blank, the cut is given up and the chunks on both sides become one, and so on
until all joins agree; a text without any blank is one chunk.

Blanks part words for good in this vocabulary (the joins rest on that, and check
it), so a task remembers the tokens of words and encodes those that it has not
met, many in one call with a special token between them.  Where normalizer and
pre-tokenizer are known to lower-case and to part letters from other characters
(:func:`parts_letters`), the Latin letters that a word begins with are looked up
in lower case and apart from what follows them.

Texts cross the network once (distinct in each batch), tokens once, both
compressed, the chunks of a batch for one bucket together.  Tokens are written
by their rank in a sample of ``CODE_DOCS`` documents, one byte for the common
ones; the sample decides about sizes only.  Batches hold at
most ``BATCH_BYTES`` of text or one document; there are as many buckets as keep
the tokens of one at ``BUCKET_BYTES`` of text.

Defined cases: a null text is empty and has no tokens; rows with equal or null
doc_id are documents of their own; extra columns are ignored; an empty table
gives no rows.  The vocabulary is a parameter: a file name that
``public_tokenizers`` knows, or a path that executors can read.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from .common import partitions, small_batches

VOCABULARY = "word_bpe_49k.json"
#: Bytes that the rolling hash sees (a power of two).
WINDOW = 32
#: A cut falls on one of so many bytes, as a power of two.
CHUNK_BITS = 9
#: Least bytes between two cuts.
LEAST = 128
BATCH_BYTES = 8 << 20
BATCH_DOCS = 8192
#: Text whose distinct chunks a task remembers.
BUCKET_BYTES = 64 << 20
#: Texts that are encoded at once, words of one call, and words that a task remembers (twice so many at most).
ENCODED, TOGETHER, REMEMBERED = 512, 64, 200_000
#: Compression level: at 6, 20 to 40 MB a second.
LEVEL = 6
#: Documents whose tokens give the ranks that tokens are written by.
CODE_DOCS = 64
_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256)), np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 13, 32])
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))  # as bytes.split has it
_ASCII_LETTER = np.isin(np.arange(256) & ~32, np.arange(65, 91)) & (np.arange(256) < 128)
#: The letters U+00C0 to U+017F, without U+0130, whose lower case is more than a letter, as UTF-8.
_LATIN = b"(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\xbf])"
_LETTERS = re.compile(b"(?:[A-Za-z]|" + _LATIN + b")+")
#: Normalizers and the pre-tokenizer under which letters and the rest of a word have tokens of their own.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer(vocabulary: str):
    """The tokenizer of a vocabulary file, loaded once in a worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tokenizers
    loaded = vars(tokenizers).setdefault("loaded_vocabularies", {})
    if vocabulary not in loaded:
        path = vocabulary
        if "/" not in path:
            import public_tokenizers
            path = public_tokenizers.path(path)
        loaded[vocabulary] = tok = tokenizers.Tokenizer.from_file(str(path))
        tok.no_padding()
        tok.no_truncation()
    return loaded[vocabulary]


def id_type(tok) -> np.dtype:
    return np.dtype("<u2" if tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


def encoded(tok, texts: list[str], kind: np.dtype) -> list[bytes]:
    many = getattr(tok, "encode_batch_fast", tok.encode_batch)
    return [np.array(e.ids, kind).tobytes() for e in many(texts, add_special_tokens=False)]


def separator(tok) -> tuple[str, int] | None:
    """A special token that is found anywhere in a text, and its id."""
    for i, t in sorted(tok.get_added_tokens_decoder().items()):
        if t.special and not (t.single_word or t.normalized):
            return t.content, i
    return None


def word_ends(tok) -> np.ndarray | None:
    suffix = getattr(tok.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    return np.array([tok.id_to_token(i).endswith(suffix) for i in range(tok.get_vocab_size(with_added_tokens=True))])


def parts_letters(tok) -> bool:
    """Whether the letters that a word begins with, in lower case, and the rest of the word have the word's tokens."""
    if tok.normalizer is None or tok.pre_tokenizer is None or any(
            t.single_word or t.normalized or _LETTERS.match(t.content.encode()) for t in tok.get_added_tokens_decoder().values()):
        return False
    normalizer, pre = (json.loads(x.__getstate__()) for x in (tok.normalizer, tok.pre_tokenizer))
    steps = pre.get("pretokenizers", [])
    return normalizer.get("normalizers") == _NORMALIZERS and [x["type"] for x in steps] == ["Split", "ByteLevel"] and (
        steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": _PARTING}, "Removed", True) and not (
        steps[1]["add_prefix_space"] or steps[1]["use_regex"])


def parted(text: bytes) -> bytes:
    """The text with a blank after the letters (ASCII, Latin) that a word begins
    with and those in lower case, if an ASCII character follows them."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return text
    letter = _ASCII_LETTER[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    lead = lead[lead + 1 < len(data)]
    pair = data[lead].astype(np.int32) << 8 | data[lead + 1]
    lead = lead[(pair & 0xC0 == 0x80) & (pair != 0xC397) & (pair != 0xC3B7) & (pair != 0xC4B0)]
    letter[lead] = letter[lead + 1] = True
    space = _SPACE[data]
    other = np.flatnonzero(np.append(~letter, True))
    starts = np.flatnonzero(letter & np.append(True, space[:-1]))
    ends = other[np.searchsorted(other, starts)]  # behind the letters
    next_byte = np.append(data, 32)[ends]
    whole = next_byte < 128
    starts, ends, next_byte = starts[whole], ends[whole], next_byte[whole]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] = -1
    small = data | (inside[:-1].cumsum(dtype=np.int8) & (data >= 65) & (data <= 90)).astype(np.uint8) << 5
    return np.insert(small, ends[~_SPACE[next_byte]], 32).tobytes()


class Words:
    """The tokens of words between blanks, each encoded when it is first met.

    Two generations of words are kept: a full one becomes the old one, and old
    words that come again move on, so common words are never forgotten.
    """

    def __init__(self, tok, kind: np.dtype, most: int = REMEMBERED):
        self.tok, self.kind, self.most = tok, kind, most
        self.mark = separator(tok)
        #: Tokens that end a word, if the vocabulary marks these.
        self.ends = word_ends(tok)
        self.parted = parts_letters(tok)
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        if len(self.known) + len(words) > self.most:
            self.known, self.old = {}, self.known
        missing = words.difference(self.known)
        new = missing.difference(self.old)
        self.known.update([(w, self.old[w]) for w in missing.difference(new)])
        mark = self.mark[0].encode() if self.mark else b""
        alone = [w for w in new if mark in w]
        if alone:
            new = new.difference(alone)
            self.known.update(zip(alone, encoded(self.tok, [w.decode("utf-8", "replace") for w in alone], self.kind)))
        rest = list(new)
        if self.ends is not None:  # words of letters alone are told apart by their last tokens
            plain = [w for w in rest if w.isalpha() or self.parted and _LETTERS.fullmatch(w)]  # isalpha of bytes: A-Z, a-z
            rest = list(new.difference(plain))
            for at in range(0, len(plain), TOGETHER):
                some = plain[at:at + TOGETHER]
                ids = np.frombuffer(encoded(self.tok, [b" ".join(some).decode()], self.kind)[0], self.kind)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(some):
                    rest += some
                    continue
                body, ends = ids.tobytes(), (ends * self.kind.itemsize).tolist()
                self.known.update([(w, body[a:b]) for w, a, b in zip(some, [0, *ends[:-1]], ends)])
        for at in range(0, len(rest), TOGETHER):
            some = rest[at:at + TOGETHER]
            text = self.mark[0].join([w.decode("utf-8", "replace") for w in some])
            ids = np.frombuffer(encoded(self.tok, [text], self.kind)[0], self.kind)
            marks = np.flatnonzero(ids == self.mark[1])
            starts, ends = np.r_[0, marks + 1].tolist(), np.r_[marks, len(ids)].tolist()
            self.known.update((w, ids[a:b].tobytes()) for w, a, b in zip(some, starts, ends, strict=True))

    def tokens(self, texts: list[bytes]) -> list[bytes]:
        """Tokens of texts that begin and end with whole words."""
        out = []
        for at in range(0, len(texts), ENCODED):
            some = texts[at:at + ENCODED]
            if self.parted:  # together; a line break and a form feed stand between texts
                some = parted(b"\n\f".join([t.replace(b"\f", b" ") for t in some])).split(b"\f")
            split = [t.split() for t in some]
            self.learn(set().union(*split))
            out += [b"".join(map(self.known.__getitem__, ws)) for ws in split]
        return out


def cuts(data: np.ndarray, bits: int = CHUNK_BITS, least: int = LEAST) -> list[int]:
    """Positions at which the rolling hash cuts a text."""
    h = _GEAR[data]
    k = 1
    while k < WINDOW and k < len(h):  # hashes of 2k bytes from two of k
        h[k:] = h[k:] + (h[:-k] << np.uint64(k))
        k *= 2
    found, last = [], 0
    for at in (np.flatnonzero(h >> np.uint64(64 - bits) == 0) + 1).tolist():
        if at - last >= least and len(h) - at >= least:
            found.append(at)
            last = at
    return found


def joins(data: bytes, bits: int = CHUNK_BITS, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """The words at the cuts with their neighbours: (left neighbour's start, start, end, right neighbour's end)."""
    array = np.frombuffer(data, np.uint8)
    at = cuts(array, bits, least) if len(data) >= 2 * least else []
    if not at:
        return []
    blank = _BLANK[array]
    # blanks at which a word begins or ends
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    out, reach = [], 0
    for c in at:
        w = int(np.searchsorted(starts, c, side="left")) - 1  # the word that begins before the cut
        if w < 1 or w + 1 >= len(starts) or starts[w - 1] < reach:
            continue  # no whole word beside the join: no cut here
        out.append((int(starts[w - 1]), int(starts[w]), int(ends[w]), int(ends[w + 1])))
        reach = int(ends[w])
    return out


class _Cutter:
    """Recipes of documents: which chunks and which words at joins make up their tokens."""

    def __init__(self, vocabulary: str, bits: int = CHUNK_BITS, least: int = LEAST):
        self.tok = tokenizer(vocabulary)
        self.kind, self.bits, self.least = id_type(self.tok), bits, least
        self.words = Words(self.tok, self.kind)

    def batch(self, ids: list, texts: list[bytes]):
        """Distinct chunks {digest: text} of a batch and the recipe: of each
        document its parts, chunks by number and words at joins below zero."""
        found = [joins(t, self.bits, self.least) for t in texts]
        keys = list({t[a:d] for t, js in zip(texts, found) for a, b, c, d in js})
        alone = list({w for t, js in zip(texts, found) for a, b, c, d in js for w in (t[a:b], t[b:c], t[c:d])})
        windows = dict(zip(alone, self.words.tokens(alone)))
        for at in range(0, len(keys), ENCODED):  # the three words of a join together, as the library does them
            some = keys[at:at + ENCODED]
            windows.update(zip(some, encoded(self.tok, [w.decode("utf-8", "replace") for w in some], self.kind)))
        chunks: dict[bytes, bytes] = {}
        place: dict[bytes, int] = {}
        recipe, words = [], []
        for t, js in zip(texts, found):
            parts, start = [], 0
            for a, b, c, d in js:
                if windows[t[a:d]] != windows[t[a:b]] + windows[t[b:c]] + windows[t[c:d]]:
                    continue  # the join doesn't agree: both sides become one chunk
                self._chunk(t[start:b], chunks, place, parts)
                words.append(windows[t[b:c]])
                parts.append(-len(words))
                start = c
            self._chunk(t[start:], chunks, place, parts)
            recipe.append(np.array(parts, np.int32))
        return chunks, (ids, recipe, words)

    @staticmethod
    def _chunk(text: bytes, chunks: dict, place: dict, parts: list) -> None:
        text = text.strip()
        if text:
            digest = hashlib.blake2b(text, digest_size=16).digest()
            chunks[digest] = text
            parts.append(place.setdefault(digest, len(place)))


def packed(parts: list[bytes]) -> bytes:
    """Byte strings as one compressed string."""
    body = np.array([len(parts), *map(len, parts)], "<i4").tobytes() + b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(body, asbytes=True)


def unpacked(data: bytes) -> list[bytes]:
    body = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    n = int.from_bytes(body[:4], "little")
    ends = 4 * (n + 1) + np.cumsum(np.frombuffer(body, "<i4", n, 4))
    return [body[a:b] for a, b in zip([4 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


def by_rank(parts: list[bytes], kind: np.dtype, ranks: np.ndarray) -> bytes:
    """Token strings as one compressed string: a byte for each of the commonest
    240 tokens, two for the next 3,840, four for others."""
    r = ranks[np.frombuffer(b"".join(parts), kind)].astype(np.int64)
    high = (r - 240) >> 8
    first = np.where(r < 240, r, np.where(high < 15, 240 + high, 255)).astype(np.uint8)
    second = ((r - 240) & 255)[(r >= 240) & (high < 15)].astype(np.uint8)
    rest = r[first == 255].astype("<u4")
    sizes = np.array([len(p) // kind.itemsize for p in parts], "<u4")
    return packed([sizes.tobytes(), first.tobytes(), second.tobytes(), rest.tobytes()])


def from_ranks(data: bytes, kind: np.dtype, order: np.ndarray) -> list[bytes]:
    sizes, first, second, rest = unpacked(data)
    r = np.frombuffer(first, np.uint8).astype(np.int64)
    two, far = (r >= 240) & (r < 255), r == 255
    r[two] = 240 + ((r[two] - 240) << 8) + np.frombuffer(second, np.uint8)
    r[far] = np.frombuffer(rest, "<u4")
    ids = order[r].astype(kind).tobytes()
    ends = (np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64) * kind.itemsize).tolist()
    return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def token_order(docs: DataFrame, vocabulary: str, sample: int = CODE_DOCS) -> np.ndarray:
    """All token ids, those that a few documents hold most often first."""
    tok = tokenizer(vocabulary)
    few = [r["text"] or "" for r in docs.select(F.substring("text", 1, 1 << 16).alias("text")).limit(sample).collect()]
    ids = np.frombuffer(b"".join(encoded(tok, few, id_type(tok))), id_type(tok))
    return np.argsort(-np.bincount(ids, minlength=tok.get_vocab_size(with_added_tokens=True)), kind="stable").astype(np.int32)


MESSAGES = "dealt long, bucket int, batch long, body binary"


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["dealt", "bucket", "batch", "body"])


def _asked(batches, vocabulary: str, bits: int, least: int, buckets: int):
    """For each batch of documents its distinct chunks, a row a bucket, and its recipe, which has no bucket."""
    cutter = _Cutter(vocabulary, bits, least)
    number = TaskContext.get().partitionId() << 32
    ids, texts, held = [], [], 0

    def flush():
        nonlocal ids, texts, held, number
        chunks, recipe = cutter.batch(ids, texts)
        of: dict[int, list] = {}
        places = []  # bucket and place in it of each chunk
        for digest, text in chunks.items():
            own = of.setdefault(int.from_bytes(digest[:8], "little") % buckets, [])
            places.append((int.from_bytes(digest[:8], "little") % buckets, len(own) // 2))
            own += (digest, text)
        rows, size = [], 0
        for bucket, own in of.items():
            rows.append((bucket, bucket, number, packed(own)))
            size += len(rows[-1][-1])
            if size > 1 << 20:
                yield _messages(rows)
                rows, size = [], 0
        rows.append((number * 0x9E3779B1 % (1 << 62), None, number,
                     packed([pickle.dumps((*recipe, places), pickle.HIGHEST_PROTOCOL)])))
        yield _messages(rows)
        ids, texts, held, number = [], [], 0, number + 1

    for b in batches:
        raw = b.column(1).cast(pa.binary())
        for at in range(0, b.num_rows, 256):
            for i, t in zip(b.column(0).slice(at, 256).to_pylist(), raw.slice(at, 256).to_pylist()):
                t = t or b""
                if ids and (held + len(t) > BATCH_BYTES or len(ids) >= BATCH_DOCS):
                    yield from flush()
                ids.append(i)
                texts.append(t)
                held += len(t)
    if ids:
        yield from flush()


def _answered(batches, vocabulary: str, order: np.ndarray):
    """Rows sorted by bucket: a chunk is encoded when it first comes, and every batch that asked gets its tokens."""
    tok = tokenizer(vocabulary)
    kind = id_type(tok)
    ranks = np.empty_like(order)
    ranks[order] = np.arange(len(order))
    words = Words(tok, kind)
    known: dict[bytes, bytes] = {}
    current = None
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("dealt", "bucket", "batch", "body"))):
            if row[1] is None:
                yield _messages([row])
                continue
            if row[1] != current:
                known, current = {}, row[1]
            parts = unpacked(row[3])
            digests, texts = parts[::2], parts[1::2]
            new = [i for i, d in enumerate(digests) if d not in known]
            known.update(zip((digests[i] for i in new), words.tokens([texts[i] for i in new])))
            yield _messages([(*row[:3], by_rank([known[d] for d in digests], kind, ranks))])


def _assembled(rows: pa.Table, kind: np.dtype, order: np.ndarray) -> pa.Table:
    """The tokens of the documents of one batch."""
    bodies = dict(zip(rows["bucket"].to_pylist(), rows["body"].to_pylist()))
    ids, parts, words, places = pickle.loads(unpacked(bodies.pop(None))[0])
    answers = {bucket: from_ranks(body, kind, order) for bucket, body in bodies.items()}
    tokens = [b"".join(answers[places[p][0]][places[p][1]] if p >= 0 else words[-p - 1] for p in ps.tolist()) for ps in parts]
    ends = np.cumsum([0] + [len(t) // kind.itemsize for t in tokens])
    values = np.frombuffer(b"".join(tokens), kind).astype(np.int32)
    return pa.table({"doc_id": pa.array(ids, pa.int64()),
                     "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))})


def asked_chunks(docs: DataFrame, vocabulary: str = VOCABULARY, bits: int = CHUNK_BITS, least: int = LEAST,
                 bucket_bytes: int | None = None) -> DataFrame:
    """What each batch of documents asks for: its distinct chunks by bucket, and its recipe (no bucket)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(partitions(spark), -(-size // (bucket_bytes or BUCKET_BYTES)))
    return rows.mapInArrow(lambda b: _asked(b, vocabulary, bits, least, buckets), MESSAGES)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, bits: int = CHUNK_BITS, least: int = LEAST) -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    small_batches(docs.sparkSession)
    kind, order = id_type(tokenizer(vocabulary)), token_order(docs, vocabulary)
    asked = asked_chunks(docs, vocabulary, bits, least).repartition("dealt").sortWithinPartitions("bucket", "batch")
    answered = asked.mapInArrow(lambda b: _answered(b, vocabulary, order), MESSAGES)
    return answered.groupBy("batch").applyInArrow(lambda t: _assembled(t, kind, order), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens`` with the decoded text of its column ``ids``; special tokens are written out."""

    @F.arrow_udf(T.StringType())
    def text(lists: pa.Array) -> pa.Array:
        tok = tokenizer(vocabulary)
        written = None
        if tok.decoder is None:  # the library then joins the tokens by blanks
            written = np.array([tok.id_to_token(i) for i in range(tok.get_vocab_size(with_added_tokens=True))], object)
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        parts = []
        for at in range(0, len(lists), 64):
            many = [values[a:b] for a, b in zip(ends[at:at + 64], ends[at + 1:at + 65])]
            if written is None:
                texts = tok.decode_batch([x.tolist() for x in many], skip_special_tokens=False)
            else:
                texts = [" ".join(written[x].tolist()) for x in many]
            parts.append(pa.array(texts, pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return tokens.withColumn(out, text(F.col(ids)))


@F.arrow_udf(T.StringType())
def ids_sha256(lists: pa.Array) -> pa.Array:
    """Digest of the ids as little-endian unsigned 32-bit integers."""
    values, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
    return pa.array([hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])], pa.string())


def report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    tokens = decode(encode(docs, vocabulary), vocabulary=vocabulary)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_sha256("ids").alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))
