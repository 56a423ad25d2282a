"""Byte-level BPE: word table, pair counts, merges, vocabulary tables.

Inside the training loop a word is a string with one character per symbol (character = symbol id,
see :func:`symbol_char`). A merge is then ``replace(word, pair, new)``, which works left to right
without overlap, and pair keys are two-character strings whose order is the order of their ids.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.functions.text import byte_text, coalesce_text, is_latin, nfkc, pre_split, python_split
from textmill.operators.bpe_blocks import folded, groups_of, pair_changes, pair_sums, symbol_char, to_blocks, to_words
from textmill.operators.order import spread
from textmill.sources.tables import Vocabulary
from textmill.storage import drop_path, stage_path, stage_table

VOCAB_SIZE = 32_000
MIN_FREQUENCY = 2
MAX_TOKEN_BYTES = 30

# The added tokens, in id order. (token, special, normalized)
BOUNDARY = "<|boundary|>"
ADDED_TOKENS = [
    (BOUNDARY, True, True),
    ("<|im_start|>", False, True),
    ("<|im_end|>", False, True),
    ("<tool_call>", False, False),
    ("</tool_call>", False, False),
    ("<think>", False, False),
    ("</think>", False, False),
    ("<|unused_special_token_0|>", True, False),
    ("<|unused_special_token_1|>", True, False),
    ("<|unused_special_token_2|>", True, False),
    ("<|unused_special_token_3|>", True, False),
]
ADDED_SCHEMA = (
    "id int, token string, special boolean, normalized boolean, unk boolean, pad boolean, eos boolean"
)

#: Distinct words a task counts before it sends them on.
WORDS_HELD = 300_000
#: Pairs the driver fetches at a time, whatever the number of pairs.
CANDIDATES = 20_000
#: Merges replayed in one pass over the words.
MERGES_PER_STAGE = 64
#: The first merges are found in many words: so many are made on blocks of words, without an index.
MERGES_WITHOUT_INDEX = 1024
#: Blocks are written anew when a pass has to replay so many groups of merges.
GROUPS_PER_FOLD = 24
#: From so many words on, replaying groups costs more than writing blocks: then after so many groups.
MANY_WORDS, GROUPS_PER_FOLD_OF_MANY = 2_000_000, 4
#: The index is built anew after this many merges, or when rounds have read the words this often.
MERGES_PER_INDEX, READS_PER_INDEX = 256, 4


def printable_byte(b: int) -> str:
    """Display character of a byte: itself if visible Latin-1, else the next one from U+0100 on."""
    return _PRINTABLE[b]


def _printable_table() -> list[str]:
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


_PRINTABLE = _printable_table()
# bytes in id order: ids 0..255 follow the display characters
ALPHABET = sorted(range(256), key=lambda b: _PRINTABLE[b])


def training_text(df: DataFrame, col: str = "text") -> DataFrame:
    """The text column, null as ""."""
    return df.select(coalesce_text(col).alias("text"))


def _exploded(array: Column, name: str) -> Column:
    """Explode an expensive array. The inner form would compute it twice: Spark adds a filter on
    its size. Empty arrays give a null that the caller drops."""
    return F.explode_outer(array).alias(name)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` from Latin texts and from the pieces of the others; counts are added up first."""
    split, counts = python_split(), Counter()

    def out() -> pa.RecordBatch:
        words, n = list(counts), list(counts.values())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    for batch in batches:
        for text, pieces in zip(*batch.columns):
            if pieces.is_valid:
                counts.update(pieces.as_py())
            elif text.is_valid:
                counts.update(split(unicodedata.normalize("NFKC", text.as_py())))
            if len(counts) > WORDS_HELD:
                yield out()
    yield out()


def word_freq(df: DataFrame, col: str = "text") -> DataFrame:
    """``word, freq``: pieces of the normalised text with their counts.

    Latin texts are normalised, split and counted in Python, each task sending a word once for all its
    occurrences. The other texts are split by the JVM, whose Unicode classes are those of :func:`pre_split`.
    """
    text, latin = F.col("text"), is_latin(F.col("text"))
    other = pre_split(nfkc(F.when(~latin, text)))
    rows = training_text(df, col).select(F.when(latin, text).alias("text"), other.alias("pieces"))
    counted = rows.mapInArrow(_counted, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("freq"))


def initial_alphabet(spark: SparkSession) -> DataFrame:
    """256 rows ``id, bytes, token``: one symbol per byte."""
    table = [(i, bytearray([b]), _PRINTABLE[b]) for i, b in enumerate(ALPHABET)]
    return spark.createDataFrame(table, "id int, bytes binary, token string")


def added_tokens(spark: SparkSession, first_id: int) -> DataFrame:
    """The added tokens with ids from ``first_id``; unk, pad and eos are the boundary token."""
    rows = [
        (first_id + i, token, special, normalized, *([token == BOUNDARY] * 3))
        for i, (token, special, normalized) in enumerate(ADDED_TOKENS)
    ]
    return spark.createDataFrame(rows, ADDED_SCHEMA).coalesce(1)


def word_symbols(words: DataFrame) -> DataFrame:
    """``symbols, freq``: every byte of the word as its symbol character."""
    latin = "".join(chr(b) for b in ALPHABET)
    marks = "".join(symbol_char(i) for i in range(256))
    return words.select(F.translate(byte_text("word"), latin, marks).alias("symbols"), "freq")


def _with_chars(symbol_words: DataFrame) -> DataFrame:
    return symbol_words.withColumn("chars", F.split("symbols", ""))


def _pairs(chars: Column) -> Column:
    n = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.zip_with(
        F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b)
    )


def pair_freq(symbol_words: DataFrame) -> DataFrame:
    """``pair, n``: adjacent symbol pairs weighted by word frequency."""
    pairs = _with_chars(symbol_words).select(_exploded(_pairs(F.col("chars")), "pair"), "freq")
    return pairs.filter("pair is not null").groupBy("pair").agg(F.sum("freq").alias("n"))


def pair_counts(words: DataFrame, min_freq: int = MIN_FREQUENCY) -> DataFrame:
    """``left, right, n``: adjacent byte symbols inside words, at least ``min_freq`` times."""
    alphabet = F.lit("".join(symbol_char(i) for i in range(256)))

    def ident(c: Column) -> Column:
        return F.instr(alphabet, c) - 1

    return (
        pair_freq(word_symbols(words))
        .filter(F.col("n") >= min_freq)
        .select(
            ident(F.substring("pair", 1, 1)).alias("left"),
            ident(F.substring("pair", 2, 1)).alias("right"),
            "n",
        )
    )


class MergeOrder:
    """Driver side of the merge loop: best pairs, applied merges, vocabulary.

    Pairs rank by (count, ids). ``best`` has the exact count of every pair that ranks before ``cut``.
    Counts of known pairs only fall and pairs with a new symbol arrive with their exact count, so this
    stays true from one full count to the next. The cut may lie inside a level of equally frequent
    pairs, and it is moved up whenever ``best`` grows beyond twice ``candidates``.

    A pair may be merged at once if it ranks before every other pair that shares a symbol with it.
    Nothing can then change its count before its turn: merges of pairs that share no symbol leave
    it alone, and a new pair (uv, s) is at most as frequent as (v, s), which ranks after it. Many
    such merges run in one round and are *applied*; they get their place and id (are *settled*) once
    every more frequent pair has been merged. The sequence is that of one merge at a time.

    The exception is a merge that spells a token that exists already, since it raises counts. It
    runs alone, in its turn; merges applied ahead of it are taken back first.
    """

    def __init__(self, vocab_size: int, min_freq: int, max_bytes: int, candidates: int = CANDIDATES):
        self.vocab_size, self.min_freq, self.max_bytes = vocab_size, min_freq, max_bytes
        self.candidates = candidates
        self.tokens = [bytes([b]) for b in ALPHABET]
        self.merges: list[tuple[int, int, int]] = []
        self.replayed: list[tuple[str, str]] = []  # settled merges as replacements
        self.bytes_of = {symbol_char(i): t for i, t in enumerate(self.tokens)}
        self.char_of = {t: c for c, t in self.bytes_of.items()}
        self.id_of = {symbol_char(i): i for i in range(len(self.tokens))}
        self.made = len(self.tokens)
        self.applied: dict[str, tuple[int, str]] = {}
        self.parts: dict[str, str] = {}  # symbol -> its pair, for symbols made since the last index
        self.best: dict[str, int] = {}
        self.cut: tuple[int, float, float] | None = None  # key of the last known pair; None: all are known
        self.rounds: list[tuple[int, int]] = []  # merges, words read

    def joined(self, pair: str) -> bytes:
        return self.bytes_of[pair[0]] + self.bytes_of[pair[1]]

    def full(self) -> bool:
        return len(self.tokens) >= self.vocab_size

    def key(self, pair: str, n: int) -> tuple[int, float, float]:
        """Place in the ranking; the ids of open symbols will be larger than all others."""
        return (-n, *(self.id_of.get(c, float("inf")) for c in pair))

    def load(self, rows) -> None:
        """Take the first ``candidates`` pairs of a full count, when every symbol has its id."""
        self.best = {r.pair: r.n for r in rows}
        self.cut = None if len(rows) < self.candidates else self.key(rows[-1].pair, rows[-1].n)

    @property
    def least(self) -> int:
        """The lowest count a pair of ``best`` may have."""
        return self.min_freq if self.cut is None else max(self.min_freq, -self.cut[0])

    def wanted(self, pair: str, n: int) -> bool:
        if n < self.min_freq or len(self.joined(pair)) > self.max_bytes:
            return False
        return self.cut is None or self.key(pair, n) <= self.cut

    def _cut_at(self, key: tuple[int, float, float]) -> None:
        self.cut = key
        self.best = {p: n for p, n in self.best.items() if self.key(p, n) <= key}

    def _shorten(self) -> None:
        """Move the cut up to a pair of settled symbols, or before a whole level."""
        if len(self.best) > 2 * self.candidates:
            ranked = sorted(self.key(p, n) for p, n in self.best.items())[: self.candidates]
            settled = [k for k in ranked if k[2] != float("inf")]
            self._cut_at(settled[-1] if settled else (ranked[-1][0], -1, -1))

    def settled(self, pair: str) -> bool:
        return all(c in self.id_of for c in pair)

    def ids(self, pair: str) -> tuple[int, ...]:
        return tuple(self.id_of[c] for c in pair)

    def precedes(self, p: str, q: str) -> bool:
        """Whether ``p`` certainly comes before the equally frequent ``q``; open ids are larger."""
        for a, b in zip(p, q):
            if a != b:
                return a in self.id_of and (b not in self.id_of or self.id_of[a] < self.id_of[b])
        return False

    def ranked(self) -> list[str]:
        return sorted(self.best, key=lambda p: -self.best[p])

    def settle(self) -> None:
        """Give applied merges their ids as long as no open pair ranks before them."""
        ranked = self.ranked()
        level = [p for p in ranked if self.best[p] == self.best[ranked[0]]]
        while self.applied and not self.full():
            ready = [p for p in self.applied if self.settled(p)]
            key, first = min((-self.applied[p][0], self.ids(p), p) for p in ready)[0::2]
            rivals = [(-self.best[q], self.ids(q)) for q in level if self.settled(q)]
            if rivals and min(rivals) < (key, self.ids(first)):
                return
            _, made = self.applied.pop(first)
            self.id_of[made] = len(self.tokens)
            self.tokens.append(self.bytes_of[made])
            self._record(first, made)

    def _record(self, pair: str, made: str) -> None:
        self.merges.append((*self.ids(pair), self.id_of[made]))
        self.replayed.append((pair, made))

    def take_back(self) -> None:
        """Forget the merges that are applied but not settled."""
        for _, made in self.applied.values():
            del self.char_of[self.bytes_of.pop(made)]
        self.applied = {}

    def next_batch(self) -> tuple[list[tuple[str, str]], bool]:
        """Merges that may run now, and whether they raise counts. An empty batch with True means
        that the applied merges have to be taken back."""
        budget = self.vocab_size - len(self.tokens)
        chosen: list[str] = []
        blocked: set[str] = set()
        spelled = set(self.char_of)
        seen = 0
        for n, group in groupby(self.ranked(), key=lambda p: self.best[p]):
            if seen >= budget:
                break
            pairs = list(group)
            seen += len(pairs)
            words = [self.joined(p) for p in pairs]
            if len(set(words)) < len(words) or spelled & set(words):
                if not chosen:  # only the very next merge is safe
                    first = min((p for p in pairs if self.settled(p)), key=self.ids)
                    if self.joined(first) in spelled:
                        return self._reuse(first)
                    chosen = [first]
                break
            sharing = defaultdict(list)
            for p in pairs:
                for c in set(p):
                    sharing[c].append(p)
            for p in pairs:
                if not blocked & set(p) and all(
                    self.precedes(p, q) for c in set(p) for q in sharing[c] if q != p
                ):
                    chosen.append(p)
                    spelled.add(self.joined(p))
            blocked.update(sharing)
        return [(p, self._apply(p)) for p in chosen], False

    def _apply(self, pair: str) -> str:
        made = symbol_char(self.made)
        self.made += 1
        self.bytes_of[made] = self.joined(pair)
        self.char_of[self.bytes_of[made]] = made
        self.parts[made] = pair
        self.applied[pair] = (self.best.pop(pair), made)
        return made

    def _reuse(self, pair: str) -> tuple[list[tuple[str, str]], bool]:
        if self.applied:
            return [], True
        made = self.char_of[self.joined(pair)]
        self._record(pair, made)
        return [(pair, made)], True

    def update(self, changes) -> None:
        """Take the changes of a round: all of known pairs, and the largest of new ones."""
        fresh = [row for row in changes if row.fresh]
        if len(fresh) == self.candidates:  # there may be more that are no more frequent than the last
            self._cut_at((-fresh[-1].delta, -1, -1))
        for row in changes:
            n = self.best.pop(row.pair, 0) + row.delta
            if self.wanted(row.pair, n):
                self.best[row.pair] = n
        self._shorten()

    def touched(self, batch: list[tuple[str, str]]) -> list[str]:
        lefts = {pair[0] for pair, _ in batch}
        rights = {pair[1] for pair, _ in batch}
        return [p for p in self.best if p[0] in rights or p[1] in lefts]

    def indexed(self, pair: str) -> str:
        """The pair of symbols of the last index that stands where the two halves of ``pair`` meet:
        every word that holds ``pair`` is listed there."""
        left, right = pair
        while left in self.parts:
            left = self.parts[left][1]
        while right in self.parts:
            right = self.parts[right][0]
        return left + right


def _literal_list(values: list[str]) -> Column:
    """One literal for the whole list, so the plan has the same shape, and the same generated
    code, in every round. Symbols start at U+0100, none is a comma."""
    return F.split(F.lit(",".join(values)), ",")


def _replace_all(symbols: Column, merges: list[tuple[str, str]]) -> Column:
    return F.aggregate(
        _literal_list([pair + made for pair, made in merges]),
        symbols,
        lambda word, m: F.replace(word, F.substring(m, 1, 2), F.substring(m, 3, 1)),
    )


def _merged(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """The words after ``merges``. The one-element explode keeps the optimizer from copying the
    chain of replacements into every later expression that reads the column."""
    if not merges:
        return words
    chain = F.array(_replace_all(F.col("symbols"), merges))
    return words.select(F.explode(chain).alias("symbols"), "freq")


def pair_index(words: DataFrame) -> DataFrame:
    """``pair, symbols, freq``: every word once for each distinct pair it holds, sorted by pair. A pair
    of very many words lies in several partitions."""
    pairs = _with_chars(words).select(_exploded(F.array_distinct(_pairs(F.col("chars"))), "pair"), "symbols", "freq")
    kept = pairs.filter("pair is not null")
    return kept.repartitionByRange("pair", "symbols").sortWithinPartitions("pair", "symbols")


def _listed(index: DataFrame, pairs: list[str]) -> DataFrame:
    """The words listed for ``pairs``, each once: where the first of these pairs that it holds is
    listed. Blocks of the index without any of the pairs are skipped by their bounds."""
    padded = sorted(pairs) + [max(pairs)] * (-len(pairs) % 16)  # few shapes of plans
    some = reduce(Column.__or__, [F.col("pair") == p for p in padded])
    first = F.coalesce(*[F.when(F.contains("symbols", F.lit(p)), F.lit(p)) for p in padded])
    return index.filter(some).filter(F.col("pair") == first).select("symbols", "freq")


#: A pair that no word holds; counts the words read.
_READ = "\x01\x02"


def _top_pairs(counts: DataFrame, order: MergeOrder):
    """The first pairs of ``pair, n`` in the ranking by (count, ids) that are short enough."""
    symbols = counts.sparkSession.createDataFrame(
        [(c, len(t), order.id_of[c]) for c, t in order.bytes_of.items()], "symbol string, size int, id int"
    )

    def side(name: str) -> DataFrame:
        columns = [F.col("symbol").alias(name), F.col("size").alias(f"{name}_size"), F.col("id").alias(f"{name}_id")]
        return F.broadcast(symbols.select(*columns))

    return (
        counts.filter(F.col("n") >= order.min_freq)
        .withColumn("left", F.substring("pair", 1, 1))
        .withColumn("right", F.substring("pair", 2, 1))
        .join(side("left"), "left")
        .join(side("right"), "right")
        .filter(F.col("left_size") + F.col("right_size") <= order.max_bytes)
        .orderBy(F.desc("n"), "left_id", "right_id")
        .select("pair", "n")
        .limit(order.candidates)
        .collect()
    )


def _changes(words: DataFrame, batch: list[tuple[str, str]], order: MergeOrder):
    """Changes of pair counts caused by ``batch`` in ``words``: ``pair, delta, fresh``, those of known
    pairs and the ``candidates`` largest of new ones; and the number of words read.

    Only pairs with a symbol of the batch can change, so the others are dropped before counting.
    """
    pairs_merged = _literal_list([pair for pair, _ in batch])
    changed = F.exists(pairs_merged, lambda p: F.contains("symbols", p))
    old = F.struct(F.split("symbols", "").alias("chars"), (-F.col("freq")).alias("delta"))
    merged = F.split(_replace_all(F.col("symbols"), batch), "")
    new = F.struct(merged.alias("chars"), F.col("freq").alias("delta"))
    read = F.struct(F.split(F.lit(_READ), "").alias("chars"), F.lit(1).cast("bigint").alias("delta"))
    sides = words.select(F.explode(F.when(changed, F.array(old, new, read)).otherwise(F.array(read))).alias("side"))
    pairs = sides.select(
        _exploded(_pairs(F.col("side.chars")), "pair"), F.col("side.delta").alias("delta")
    )
    involved = "".join(sorted({c for pair, made in batch for c in pair + made}))
    deltas = (
        pairs.filter((F.translate("pair", involved, "") != F.col("pair")) | (F.col("pair") == _READ))
        .groupBy("pair")
        .agg(F.sum("delta").alias("delta"))
    )
    rows = _largest(deltas, batch, order)
    return [r for r in rows if r.pair != _READ], sum(r.delta for r in rows if r.pair == _READ)


def _largest(deltas: DataFrame, batch: list[tuple[str, str]], order: MergeOrder):
    """The rows of ``pair, delta`` that the driver wants, with ``fresh``."""
    fresh = F.translate("pair", "".join(made for _, made in batch), "") != F.col("pair")
    kept = fresh & (F.col("delta") >= order.least)
    touched = order.touched(batch)
    if touched:
        kept = kept | F.array_contains(_literal_list(touched), F.col("pair"))
    return (
        deltas.filter((F.col("delta") != 0) & (kept | (F.col("pair") == _READ)))
        .withColumn("fresh", fresh)
        .orderBy("fresh", F.desc("delta"))
        .limit(1 + len(touched) + order.candidates)
        .collect()
    )


def train_merges(
    words: DataFrame,
    symbols_wanted: int,
    min_freq: int = MIN_FREQUENCY,
    max_token_length: int = MAX_TOKEN_BYTES,
    candidates: int = CANDIDATES,
) -> MergeOrder:
    """Greedy merges over a ``word, freq`` table until ``symbols_wanted`` symbols exist.

    A full pair count fetches the first ``candidates`` pairs. After that a round fetches the changed
    counts. The first ``MERGES_WITHOUT_INDEX`` merges are made on blocks of words, in passes of a few vector
    operations; blocks are written anew after ``GROUPS_PER_FOLD`` groups of merges, sooner where words are many. Later rounds read the
    words that an index lists for their pairs. The index is not written between two
    builds: words are listed as they were then, the merges since are replayed on the listed words,
    and words that no longer hold the pair drop out. After ``MERGES_PER_INDEX`` merges, when rounds
    have read ``READS_PER_INDEX`` times the words, and before a full count, all words are brought up
    to date in the shared folder and listed anew.
    """
    spark = words.sparkSession
    order = MergeOrder(symbols_wanted, min_freq, max_token_length, candidates)

    def staged(table: DataFrame, name: str = "words") -> tuple[str, DataFrame]:
        path = stage_path(spark, name)
        return path, stage_table(table, name, path)

    def refolded(start: DataFrame, merges: list[tuple[str, str]], keep: str) -> tuple[str, DataFrame]:
        """Write ``start`` after ``merges``, a bounded number of them at a time."""
        path, table = keep, start
        for i in range(0, len(merges), MERGES_PER_STAGE):
            old = path
            path, table = staged(_merged(table, merges[i : i + MERGES_PER_STAGE]))
            if old not in (keep, origin):
                drop_path(spark, old)
        return path, table

    def drop(old: str) -> None:
        if old not in (origin, path):
            drop_path(spark, old)

    origin, first = staged(word_symbols(words))
    total = first.count()
    per_fold = GROUPS_PER_FOLD if total < MANY_WORDS else GROUPS_PER_FOLD_OF_MANY
    path, base = staged(to_blocks(spread(first, ["symbols"])), "blocks")
    in_blocks = True
    index_path, source = None, None
    pending: list[tuple[str, str]] = []
    reads, recount, stale = 0, True, False
    while True:
        order.settle()
        if order.full():
            break
        if not recount and not order.best:
            if order.cut is None:
                break
            recount = stale = True
        if in_blocks:
            old = path
            if len(order.replayed) + len(order.applied) >= MERGES_WITHOUT_INDEX:
                path, base = staged(to_words(base, pending, order.made))
                in_blocks, pending, stale = False, [], True
            elif len(groups_of(pending)) >= per_fold:
                path, base = staged(folded(base, pending, order.made), "blocks")
                pending = []
            drop(old)
        if in_blocks:
            if recount:
                order.load(_top_pairs(pair_sums(base, pending, order.made), order))
                recount = False
                continue
        else:
            if len(pending) >= MERGES_PER_INDEX or reads > READS_PER_INDEX * total:
                stale = True
            if stale:
                if source is not None:
                    source.unpersist()
                    drop_path(spark, index_path)
                index_path, source = None, None
                old = path
                path, base = refolded(base, pending, path)
                drop(old)
                pending, reads, stale = [], 0, False
                order.parts = {}
            if recount:
                order.load(_top_pairs(pair_freq(base), order))
                recount = False
                continue
            if source is None:
                index_path, source = staged(pair_index(base), "index")
                source.persist()
        batch, raises = order.next_batch()
        if raises and not batch:
            order.take_back()
            old = path
            if in_blocks:
                path, base = staged(to_blocks(spread(first, ["symbols"])), "blocks")
                pending = list(order.replayed)
            else:
                path, base = refolded(first, order.replayed, origin)
                pending, stale = [], True
            recount = True
            drop(old)
            continue
        if raises:
            recount = stale = True
        elif in_blocks:
            order.update(_largest(pair_changes(base, pending, batch, order.made), batch, order))
            order.rounds.append((len(batch), total))
        else:
            # pairs of symbols made in this batch do not occur yet
            listed = _listed(source, list({order.indexed(pair) for pair, _ in batch}))
            changes, read = _changes(_merged(listed, pending), batch, order)
            order.update(changes)
            order.rounds.append((len(batch), read))
            reads += read
        pending += batch
    if source is not None:
        source.unpersist()
        drop_path(spark, index_path)
    for used in {origin, path}:
        drop_path(spark, used)
    return order


def training_rounds(spark: SparkSession, trained: MergeOrder) -> DataFrame:
    """``round, merges, words_read`` of a training."""
    rows = [(i, merges, read) for i, (merges, read) in enumerate(trained.rounds)]
    return spark.createDataFrame(rows, "round int, merges int, words_read bigint").coalesce(1)


def assemble_vocab(spark: SparkSession, trained: MergeOrder) -> Vocabulary:
    """Trained tokens with ids in training order, then the added tokens."""
    learned = [
        (i, bytearray(t), "".join(_PRINTABLE[b] for b in t))
        for i, t in enumerate(trained.tokens)
        if i >= len(ALPHABET)
    ]
    vocab = initial_alphabet(spark).unionByName(
        spark.createDataFrame(learned, "id int, bytes binary, token string")
    )
    merges = spark.createDataFrame(
        [(rank, *merge) for rank, merge in enumerate(trained.merges)],
        "rank int, left int, right int, id int",
    )
    return Vocabulary(
        vocab.coalesce(1), merges.coalesce(1), added_tokens(spark, len(trained.tokens))
    )


def train_bpe(
    df: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_freq: int = MIN_FREQUENCY,
    max_token_length: int = MAX_TOKEN_BYTES,
    col: str = "text",
) -> Vocabulary:
    """Train a vocabulary of ``vocab_size`` tokens, the added ones included, on a text column."""
    trained = train_merges(
        word_freq(df, col), vocab_size - len(ADDED_TOKENS), min_freq, max_token_length
    )
    return assemble_vocab(df.sparkSession, trained)
