"""Ranked lexical search: the items' terms times the documents' impacts, as dense blocks of float64 products.

A tile of items is a matrix of term counts over the few terms that these items hold; a tile of documents is a matrix of
the impacts of the same terms. Their product (BLAS) gives all scores of the two tiles. Every number in it is an integer,
and columns are split so that no sum can reach 2^53: the products are exact, whatever the order of summation; sums beyond
that are made in int64. Of a tile only scores that can still be among the best k go on; equal scores go by id.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tracelake.llm.common import as_bytes, batch_slices, ship, stored

#: ASCII letters and digits stay, A-Z lower-cased, other ASCII signs part terms; bytes of other characters stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Texts of items that are broadcast at a time (more items take several passes), items and documents of a tile, its terms.
ITEM_BYTES, TILE_ITEMS, TILE_DOCS, TILE_TERMS = 8 << 20, 256, 256, 4096
#: Up to so many tiles of items are kept dense by a task; of more, each is made dense when its turn comes.
DENSE_TILES = 8
#: No factor of a weight in an impact reaches this; no partial sum of a product reaches EXACT.
IMPACT, EXACT = 10**6, 1 << 53
#: Candidates that a task holds over all tiles of items (at least two rounds of the best) before it keeps the best k of each.
HELD = 50_000


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order: runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_TERM_BYTES).split()


class Queries:
    """Items as sparse counts over the vocabulary of their terms."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        self.items: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            counts = Counter(terms_of(text))
            ids = [self.number.setdefault(t, len(self.number)) for t in counts]
            self.items.append((np.array(ids, np.int64), np.array(list(counts.values()), np.int64)))


class Tile:
    """Some items and their compact vocabulary: slabs of counts [item, term] whose products stay exact.

    A slab is its first column, its width and its counts as (item, column, count), and the dense matrix if ``keep``.
    """

    def __init__(self, first: int, items: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, most: int = TILE_TERMS, keep: bool = True):
        self.first, self.n, self.keep = first, len(items), keep
        self.terms = np.unique(np.concatenate([ids for ids, _ in items])) if items else np.zeros(0, np.int64)
        counts = np.zeros((self.n, len(self.terms)))
        for i, (ids, n) in enumerate(items):
            counts[i, np.searchsorted(self.terms, ids)] = n
        self.slabs = []
        for at in range(0, len(self.terms), most):
            self._split(np.arange(at, min(at + most, len(self.terms))), counts[:, at : at + most], weight)

    def _split(self, columns: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> None:
        bound = counts @ (weight[self.terms[columns]].astype(float) * IMPACT)
        if bound.max(initial=0) < 0.99 * EXACT:
            item, column = np.nonzero(counts)
            self.slabs.append((int(columns[0]), len(columns), item, column, counts[item, column], counts if self.keep else None))
        elif len(columns) > 1:
            half = len(columns) // 2
            self._split(columns[:half], counts[:, :half], weight)
            self._split(columns[half:], counts[:, half:], weight)
        else:
            part = np.floor(counts / 2)
            self._split(columns, part, weight)
            self._split(columns, counts - part, weight)

    def scores(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores [item, document] in int64 of a tile of documents, given its impacts as (term, document, impact)."""
        total = np.zeros((self.n, n_docs), np.int64)
        if not len(self.terms):
            return total
        column = np.searchsorted(self.terms, term)
        column[column == len(self.terms)] = 0
        hit = self.terms[column] == term
        column, doc, impact = column[hit], doc[hit], impact[hit]
        for first, width, item, at, n, counts in self.slabs:
            inside = (column >= first) & (column < first + width)
            dense = np.zeros((width, n_docs))
            dense[column[inside] - first, doc[inside]] = impact[inside]
            if counts is None:
                counts = np.zeros((self.n, width))
                counts[item, at] = n
            total += (counts @ dense).astype(np.int64)
        return total


class Best:
    """The best k of each item of a tile: by score, then by id (null first)."""

    def __init__(self, n_items: int, k: int, most: int | None = None):
        self.k, self.most = k, HELD if most is None else most
        self.least = np.ones(n_items, np.int64)  # a score below this is out; 0 is none
        self.item, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, scores: np.ndarray, ids: list) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        self.parts.append((item, scores[item, doc]))
        self.ids += [ids[d] for d in doc.tolist()]
        self.held += len(item)
        if self.held > self.most:
            self.shrink()

    def shrink(self) -> None:
        item = np.concatenate([self.item, *(i for i, _ in self.parts)])
        score = np.concatenate([self.score, *(s for _, s in self.parts)])
        place = {v: r for r, v in enumerate(sorted(set(self.ids), key=lambda v: (v is not None, v)))}
        order = np.lexsort((np.array([place[v] for v in self.ids], np.int64), -score, item))
        item, score = item[order], score[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[item[last]] = score[last]  # ties with the last place stay in: a smaller id may come
        order = order[keep].tolist()
        self.item, self.score, self.ids = item[keep], score[keep], [self.ids[i] for i in order]
        self.parts, self.held = [], 0


def _sparse(number, id_type: pa.DataType):
    """Per document with terms: its id, number of terms, and the items' terms in it with their counts (int32 each)."""

    def run(batches):
        vocabulary = number.value
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                keep, n, ids, counts = [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    tf = Counter(words)
                    shared = tf.keys() & vocabulary.keys()
                    keep.append(i)
                    n.append(len(words))
                    ids.append(np.fromiter((vocabulary[t] for t in shared), "<i4", len(shared)).tobytes())
                    counts.append(np.fromiter((tf[t] for t in shared), "<i4", len(shared)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep, pa.int32())).cast(id_type), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def _frequencies(n_terms: int):
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                df[np.frombuffer(data, "<i4")] += 1  # a term stands once in a row
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["term", "df"])

    return run


def _search(model, k: int, id_type: pa.DataType):
    def run(batches):
        items, weight, n_docs, n_terms = model.value
        starts = range(0, len(items), TILE_ITEMS)
        tiles = [Tile(at, items[at : at + TILE_ITEMS], weight, keep=len(starts) <= DENSE_TILES) for at in starts]
        best = [Best(t.n, k, max(2 * k * t.n, HELD // len(tiles))) for t in tiles]
        for whole in batches:
            for part in batch_slices(whole, "terms"):
                for at in range(0, part.num_rows, TILE_DOCS):
                    batch = part.slice(at, TILE_DOCS)
                    ids, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                    terms = [np.frombuffer(x, "<i4") for x in batch.column(2).to_pylist()]
                    tf = np.concatenate([np.frombuffer(x, "<i4") for x in batch.column(3).to_pylist()]).astype(np.int64)
                    doc = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
                    term = np.concatenate(terms).astype(np.int64)
                    norm = np.array([75 + 25 * n * n_docs // n_terms for n in lengths], np.int64)[doc]
                    impact = (weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * norm))).astype(float)
                    for tile, top in zip(tiles, best, strict=True):
                        top.add(tile.scores(term, doc, impact, len(ids)), ids)
        for tile, top in zip(tiles, best, strict=True):
            top.shrink()
            if len(top.item):
                yield pa.RecordBatch.from_arrays([pa.array(top.item + tile.first, pa.int64()), pa.array(top.score, pa.int64()), pa.array(top.ids, id_type)], names=["item", "score", "doc_id"])

    return run


def _pass(docs: DataFrame, items: list[tuple], k: int, item_type: T.DataType) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    doc_type = docs.schema["doc_id"]
    queries = Queries([t for _, t in items])
    kind = T.StructType([T.StructField("doc_id", doc_type.dataType), T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    sparse = stored(docs.mapInArrow(_sparse(sc.broadcast(queries.number), to_arrow_type(doc_type.dataType)), kind), "search-terms")
    n_docs, n_terms = sparse.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(queries.number), np.int64)
    counted = sparse.select("terms").mapInArrow(_frequencies(len(weight)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in counted.collect():  # one row per term of the items of this pass
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    model = sc.broadcast((queries.items, weight, n_docs, n_terms))
    found = sparse.mapInArrow(_search(model, k, to_arrow_type(doc_type.dataType)), T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), doc_type]))
    # in two steps, as every task has its own best k of an item
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    rank = F.row_number()
    found = found.withColumn("salt", F.spark_partition_id() % 64)
    found = found.withColumn("rank", rank.over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    found = found.withColumn("rank", rank.over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(items)], T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)]))
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of every row of ``items``.

    N documents hold a term; L are all their terms; df documents hold the term, tf times in this one of n terms:

        weight = floor(1000 ln((2N + 2) / (2 df + 1)))
        norm   = 75 + 25 n N div L
        score  = sum over the item's terms, repeats included, of weight * (10^9 tf div (1000 tf + 12 norm))

    Equal scores go by ascending id, null first. Every row is a document or an item of its own, also one that repeats.
    Null or empty texts have no terms: such items find nothing, such documents do not count. Other columns are not read.

    Documents are read once for all items up to ``item_bytes`` of their text, which is broadcast; more items are dealt to
    as many passes. What a pass keeps of a document are the items' terms in it. Tasks send at most k rows per item.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(doc_id).alias("doc_id"), as_bytes(doc_text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), as_bytes(item_text).alias("text"))
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-size // item_bytes))
    kind, found = items.schema[item_id].dataType, None
    if passes > 1:
        asked = stored(asked.withColumn("pass", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(passes))), "search-items")
    for p in range(passes):
        rows = asked.where(F.col("pass") == p).drop("pass") if passes > 1 else asked
        part = _pass(src, [(r["item_id"], bytes(r["text"])) for r in rows.collect()], k, kind)
        found = part if found is None else found.unionByName(part)
    return found
