"""Cross-tokenizer alignment: which tokens of two tokenizers share bytes, over a whole corpus.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (BPE over pieces with byte fallback,
which adds that space itself) the text; strings of special tokens are plain text. Byte offsets where both
end a token cut the tokens into groups; tokens of A and B whose byte ranges overlap are linked. The score
of a pair of ids is the number of links that hold it, corpus-wide.

Counting goes over **inverted pair bitmaps**. Documents are numbered in blocks of bounded size. For every
pair of ids a block has compressed bitmaps of its documents: one of the documents that hold the pair, and
multiplicity planes for their link counts (plane k: documents whose count less one has bit k). The
containers of a block are merged by OR while it is read; containers of different blocks hold different
documents, so a pair's popcounts add up: documents from the first bitmap, links from all planes. Scores
return to the documents through the same postings: each container brings the count of its pair to the
documents whose bits are set. What is shuffled is one small row per pair, block and plane, never a row per
link, and a pair has no more rows in one place than there are blocks.

Tokens are found once per stretch of text, not once per place: a cut before white space that follows other
text is one in both tokenizers (A's words never run from text into white space; for B the vocabulary is
searched for pieces that do, and white space they use is no cut). Ids, groups and links of a stretch depend
on nothing outside, and those of the common ones are remembered within a task, in a table of bounded size.

Defined results: texts that are null, empty, or whose tokens do not give back their bytes have no tokens: all
counts are 0 and the hash is the empty text. Repeated rows count and are listed one by one. A text of any
length is read whole; a block holds at least one document. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import kept_table, row_sums, share, shared_model, table

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: White space of A's word pattern.
SPACES = "".join(
    map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
#: A block of documents ends at this many documents or characters, whichever comes first.
BLOCK_DOCS = 1 << 13
BLOCK_CHARS = 1 << 22
#: Documents and characters that are looked up together; characters of one call of the tokenizers.
GROUP_DOCS, GROUP_CHARS, CALL_CHARS = 1 << 10, 1 << 20, 1 << 11
#: Stretches that are remembered from block to block.
REMEMBERED = 250_000
#: Ids of B need fewer bits than this.
B_BITS = 20
ROWS_OUT = 1 << 15
#: Set bits that are read at a time when scores return.
BITS_READ = 1 << 20


@dataclass
class Files:
    """The two tokenizers as their files' bytes: of fixed size, and read by the driver alone."""

    a: str
    b: bytes

    @classmethod
    def read(cls, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> Files:
        with open(a, encoding="utf-8") as x, open(b, "rb") as y:
            return cls(x.read(), y.read())


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Growing:
    """Numbers that are added at the end; ``all`` is a view of them."""

    def __init__(self):
        self.n, self.space = 0, np.empty(1 << 12, np.int64)

    def add(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.space):
            self.space = np.concatenate([self.space[: self.n], np.empty(max(need, 2 * self.n) - self.n, np.int64)])
        self.space[self.n : need] = values
        self.n = need

    @property
    def all(self) -> np.ndarray:
        return self.space[: self.n]


class Stretches:
    """What is known of stretches of text, by number. ``n_a`` is -1 where the tokens do not give back the text."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.n_a, self.n_b, self.n_groups, self.n_links = Growing(), Growing(), Growing(), Growing()
        self.links = Growing()  # a pair of ids each: a << B_BITS | b
        self.groups: list[str] = []

    def add(self, parts, n_a, n_b, n_groups, n_links, links, groups) -> None:
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts))))
        for mine, more in zip((self.n_a, self.n_b, self.n_groups, self.n_links, self.links), (n_a, n_b, n_groups, n_links, links)):
            mine.add(more)
        self.groups += groups


class Aligner:
    """Tokens, groups and links of texts; made once per task."""

    def __init__(self, files: Files):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        special = {i: t.content for i, t in self.a.get_added_tokens_decoder().items()}
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [
            special[i].encode() if i in special else bytes(alphabet[c] for c in names.get(i, ""))
            for i in range(max(names, default=-1) + 1)
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        assert self.b.get_piece_size() <= 1 << B_BITS
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.lone_mark = self.b.piece_to_id(MARK)
        self.a_size, self.b_size = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        # ids as text, with what stands behind them inside a group and at the end of their side of it
        self.a_text, self.b_text = (
            [np.array([f"{i}{end}" for i in range(len(x))], object) for end in (",", last)]
            for x, last in ((self.a_bytes, "|"), (self.b_bytes, ";"))
        )
        plain = [p.replace(MARK, " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        joined = {p[k] for p in plain for k in range(1, len(p)) if p[k] in SPACES and p[k] != p[k - 1]}
        s, inner = re.escape(SPACES), re.escape("".join(joined))
        more = f"(?:[{inner}][{s}]*[^{s}]*)*" if inner else ""
        self.cut = re.compile(f"[{s}]*[^{s}]+{more}|[{s}]+").findall
        self.known = Stretches()

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a text that already has its leading white space."""
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if text.startswith(" "):
            b = self.b.encode(text[1:]) if len(text) > 1 else [self.lone_mark]
        else:  # the space that the tokenizer adds is a token of its own here
            b = self.b.encode(text)
            b = b[1:] if b[:1] == [self.lone_mark] else []
        return np.array(a, np.int64), np.array(b, np.int64)

    def learn(self, parts: list[str]) -> None:
        """Read new stretches; those that may stand one after the other go through the tokenizers together."""
        together: list[str] = []
        size = 0
        for part in parts:
            if part[-1] in SPACES:
                self._learn([part])
                continue
            together.append(part)
            size += len(part)
            if size >= CALL_CHARS:
                self._learn(together)
                together, size = [], 0
        if together:
            self._learn(together)

    def _learn(self, parts: list[str]) -> None:
        a, b = self.ids("".join(parts))
        sizes = np.array([len(p.encode("utf-8", "surrogatepass")) for p in parts])
        data = "".join(parts).encode("utf-8", "surrogatepass")
        same = all(
            b"".join(map(names.__getitem__, ids.tolist())) == data for names, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )
        none = np.zeros(1, np.int64)
        if not same and len(parts) == 1:
            return self.known.add(parts, none - 1, none, none, none, none[:0], [""])
        ends_a, ends_b, ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(sizes)
        if not same or not (np.isin(ends, ends_a).all() and np.isin(ends, ends_b).all()):
            for part in parts:
                self._learn([part])
            return None
        in_a, in_b = (np.zeros(len(data) + 1, np.int64) for _ in range(2))
        in_a[ends_a] = in_b[ends_b] = 1
        both = in_a & in_b
        before_a, before_b, before = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b, np.cumsum(both) - both
        cuts = np.flatnonzero(in_a | in_b)  # each stretch of bytes up to a cut is in one token of either side
        links = a[before_a[cuts]] << B_BITS | b[before_b[cuts]]
        texts = np.concatenate(
            [np.where(both[x] == 1, t[1][i], t[0][i]) for x, t, i in ((ends_a, self.a_text, a), (ends_b, self.b_text, b))]
        )
        texts = texts[np.argsort(np.concatenate([2 * before[ends_a], 2 * before[ends_b] + 1]), kind="stable")].tolist()
        per = lambda marks: np.diff(marks[ends] + 1, prepend=0)
        n_a, n_b = per(before_a), per(before_b)
        stops = np.cumsum(n_a + n_b).tolist()
        groups = ["".join(texts[x:y]) for x, y in zip([0, *stops], stops)]
        n_links = np.diff(np.searchsorted(cuts, ends, side="right"), prepend=0)
        self.known.add(parts, n_a, n_b, per(before), n_links, links, groups)
        return None

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """Numbers of the stretches of a space and each text; none for texts without tokens."""
        cut = [self.cut(" " + t) if t and MARK not in t else [] for t in texts]  # a mark would come back as a space
        number = self.known.number
        fresh = dict.fromkeys(p for parts in cut for p in parts if p not in number)
        if fresh:
            self.learn(list(fresh))
        found = [np.fromiter(map(number.__getitem__, parts), np.int64, len(parts)) for parts in cut]
        n_a = self.known.n_a.all
        return [f if not len(f) or n_a[f].min() >= 0 else f[:0] for f in found]

    def hashed(self, found: np.ndarray) -> str:
        if not len(found):
            return ""
        text = "".join(map(self.known.groups.__getitem__, found.tolist()))
        return hashlib.sha256(text[:-1].encode()).hexdigest()

    def forget(self) -> None:
        """Start anew when much is known; between blocks only, as they hold numbers."""
        if len(self.known.number) > REMEMBERED:
            self.known = Stretches()


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bitmaps(pairs: np.ndarray, docs: np.ndarray, n_docs: int) -> list[tuple[int, int, bytes]]:
    """(pair, documents, bits) for (pair, document) rows in order; ``documents_of`` reads the bits."""
    if not len(pairs):
        return []
    cuts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    ends = np.r_[cuts[1:], len(pairs)]
    gaps = np.diff(docs, prepend=0)
    gaps[cuts] = docs[cuts]
    wide = gaps >= 128  # seven bits a byte, the lower ones first
    at = np.cumsum(1 + wide) - (1 + wide)
    data = np.empty(int(at[-1]) + 1 + int(wide[-1]), np.uint8)
    data[at] = np.where(wide, 128 | (gaps & 127), gaps)
    data[at[wide] + 1] = gaps[wide] >> 7
    raw, starts = data.tobytes(), np.r_[at[cuts], len(data)].tolist()
    full = (n_docs + 7) // 8
    out = []
    for pair, lo, hi, x, y in zip(pairs[cuts].tolist(), cuts.tolist(), ends.tolist(), starts, starts[1:]):
        if y - x < full:
            bits = b"\0" + raw[x:y]
        else:
            flags = np.zeros(n_docs, bool)
            flags[docs[lo:hi]] = True
            bits = b"\1" + np.packbits(flags, bitorder="little").tobytes()
        out.append((pair, hi - lo, bits))
    return out


def documents_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every set bit of the bitmaps between the offsets, as row and document.

    A bitmap is a byte for its form and then gaps (0: seven bits a byte, lower ones first, the top bit says
    that another byte follows) or plain bits (1).
    """
    sizes = np.diff(offsets) - 1
    form = data[offsets[:-1]]
    rows, docs = [], []
    gaps = np.flatnonzero(form == 0)
    if len(gaps):
        size = sizes[gaps]
        place = np.repeat(offsets[gaps] + 1 - np.cumsum(size) + size, size) + np.arange(size.sum())
        raw, row = data[place].astype(np.int64), np.repeat(gaps, size)
        head = np.r_[True, raw[:-1] < 128]
        value = np.where(raw >= 128, (raw & 127) | (np.r_[raw[1:], 0] << 7), raw)[head]
        row = row[head]
        total = np.cumsum(value)
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        before = np.repeat(total[first] - value[first], np.diff(np.r_[first, len(row)]))
        rows.append(row)
        docs.append(total - before)
    for i in np.flatnonzero(form == 1).tolist():
        found = np.flatnonzero(np.unpackbits(data[offsets[i] + 1 : offsets[i + 1]], bitorder="little"))
        rows.append(np.full(len(found), i))
        docs.append(found)
    return np.concatenate(rows), np.concatenate(docs)


def postings(known: Stretches, docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, bytes]]:
    """(pair, plane, documents, bits) of a block's documents; plane -1 holds the documents of the pair."""
    n, numbers = len(docs), np.concatenate(docs)
    if not len(numbers):
        return
    used, numbers = np.unique(numbers, return_inverse=True)
    doc = np.repeat(np.arange(n), [len(d) for d in docs])
    keys, times = np.unique(numbers * n + doc, return_counts=True)
    ends = np.cumsum(known.n_links.all)[used]
    size = known.n_links.all[used]
    starts = np.cumsum(size) - size
    place = np.repeat(ends - size - starts, size) + np.arange(size.sum())
    names, pair_of = np.unique(known.links.all[place], return_inverse=True)
    stretch, doc = np.divmod(keys, n)
    size = size[stretch]
    place = np.repeat(starts[stretch] - np.cumsum(size) + size, size) + np.arange(size.sum())
    keys, times = summed(pair_of[place] * n + np.repeat(doc, size), np.repeat(times, size))
    pair, doc = np.divmod(keys, n)
    pair, extra, plane = names[pair], times - 1, -1
    yield from ((p, -1, k, bits) for p, k, bits in bitmaps(pair, doc, n))
    while (extra > 0).any():
        plane += 1
        odd = (extra & 1) == 1
        yield from ((p, plane, k, bits) for p, k, bits in bitmaps(pair[odd], doc[odd], n))
        extra >>= 1


ROWS = (
    "block long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair long, plane int, n_docs long, bits binary"
)
ARROW = pa.schema(
    [("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("n_docs", pa.int64())]
    + [("bits", pa.binary())]
)


def read_blocks(docs: DataFrame, files: Files) -> DataFrame:
    """One pass over the texts: a row per document (``pair`` null) and a row per pair, block and plane."""
    shared = share(docs.sparkSession, files)
    picked = docs.select("doc_id", F.col("text").alias("__text"))

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in ARROW],
            schema=ARROW,
        )

    def ended(aligner: Aligner, block: list[np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
        some: list[tuple] = []

        def packed() -> pa.RecordBatch:
            pair, plane, n, bits = zip(*some)
            return rows(block=[number] * len(some), pair=pair, plane=plane, n_docs=n, bits=bits)

        for row in postings(aligner.known, block):
            some.append(row)
            if len(some) == ROWS_OUT:
                yield packed()
                some.clear()
        if some:
            yield packed()
        aligner.forget()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(shared_model(shared))
        number = TaskContext.get().partitionId() << 32  # tasks that are run again number alike
        block: list[np.ndarray] = []
        n_chars = 0
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:
                before = sizes[first - 1] if first else 0
                last = int(np.searchsorted(sizes, before + GROUP_CHARS, side="right"))
                last = min(max(last, first + 1), first + min(GROUP_DOCS, BLOCK_DOCS), batch.num_rows)
                found = aligner.texts(batch.column(1).slice(first, last - first).to_pylist())
                known = aligner.known
                at = np.cumsum([0, *map(len, found)])
                each = np.concatenate(found)
                sums = [row_sums(c.all[each], at) for c in (known.n_a, known.n_b, known.n_groups, known.n_links)]
                yield rows(
                    block=np.full(len(found), number), doc=np.arange(len(block), len(block) + len(found), dtype=np.int32),
                    doc_id=batch.column(0).slice(first, last - first), groups_sha256=list(map(aligner.hashed, found)),
                    **{c: x.astype(np.int64) for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), sums)},
                )
                block += found
                n_chars += int(sizes[last - 1] - before)
                first = last
                if len(block) >= BLOCK_DOCS or n_chars >= BLOCK_CHARS:
                    yield from ended(aligner, block, number)
                    block, n_chars, number = [], 0, number + 1
        if block:
            yield from ended(aligner, block, number)

    return picked.mapInArrow(run, ROWS)


def pair_scores(postings: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links): documents that hold each pair of ids, and links corpus-wide."""
    first = F.col("plane") < 0
    weight = F.when(first, 1).otherwise(F.pow(F.lit(2.0), F.col("plane"))).cast("long")
    return postings.groupBy("pair").agg(
        F.sum(F.when(first, F.col("n_docs")).otherwise(0)).alias("n_docs"), F.sum(weight * F.col("n_docs")).alias("n_links")
    )


def returned(postings: DataFrame, scores: DataFrame) -> DataFrame:
    """(block, doc, n_best, count_sum): what the postings bring back to the documents."""
    b = F.col("pair") % (1 << B_BITS)
    highest = scores.groupBy(b.alias("b")).agg(F.max("n_links").alias("highest"))  # a row per id of B at most
    marked = scores.join(F.broadcast(highest), b == F.col("b")).select(
        "pair", "n_links", (F.col("n_links") == F.col("highest")).cast("int").alias("best")
    )
    marked = kept_table(marked, "pairs").hint("merge")  # one plan at any size
    rows = postings.join(marked, "pair").select("block", "plane", "n_docs", "bits", "n_links", "best")

    def run(whole: pa.Table) -> pa.Table:
        whole = whole.combine_chunks()
        n_docs = np.cumsum(np.asarray(whole.column("n_docs")))
        cuts = np.searchsorted(n_docs, np.arange(0, n_docs[-1], BITS_READ), side="left")
        parts = [brought(whole.slice(x, y - x)) for x, y in zip(cuts, [*cuts[1:], len(n_docs)]) if x < y]
        doc = np.concatenate([p[0] for p in parts])
        names, doc = np.unique(doc, return_inverse=True)
        sums = []
        for i in (1, 2):
            total = np.zeros(len(names), np.int64)
            np.add.at(total, doc, np.concatenate([p[i] for p in parts]))
            sums.append(total)
        block = np.full(len(names), whole.column("block")[0].as_py())
        return pa.table([block, names.astype(np.int32), *sums], names=["block", "doc", "n_best", "count_sum"])

    def brought(rows: pa.Table) -> list[np.ndarray]:
        """Documents with their sums of some postings."""
        weight = np.left_shift(1, np.maximum(np.asarray(rows.column("plane")), 0).astype(np.int64))
        bits = rows.column("bits").combine_chunks()
        offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1].astype(np.int64)
        row, doc = documents_of(np.frombuffer(bits.buffers()[2], np.uint8), offsets)
        order = np.argsort(doc, kind="stable")
        doc, row = doc[order], row[order]
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        values = [(weight * np.asarray(rows.column(c)).astype(np.int64))[row] for c in ("best", "n_links")]
        return [doc[first], *(np.add.reduceat(v, first) for v in values)]

    return rows.groupBy("block").applyInArrow(run, "block long, doc int, n_best long, count_sum long")


def align(docs: DataFrame, files: Files | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): counts, hash and returned scores of every document; counts of every pair of ids."""
    both = kept_table(read_blocks(docs, files or Files.read()), "alignment")
    postings = both.where("pair is not null").select("block", "pair", "plane", "n_docs", "bits")
    scores = kept_table(pair_scores(postings), "scores")
    own = both.where("pair is null").drop("pair", "plane", "n_docs", "bits")
    zero = F.lit(0).cast("long")
    found = own.join(returned(postings, scores).hint("merge"), ["block", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
    pairs = scores.select(
        F.shiftright("pair", B_BITS).cast("int").alias("a"), (F.col("pair") % (1 << B_BITS)).cast("int").alias("b"), "n_docs", "n_links"
    )
    return found, pairs


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))[0]
