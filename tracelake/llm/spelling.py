"""Spelling variants: a vocabulary acceptor composed with a one-edit transducer and the acceptor again.

The acceptor A of a set of words is minimal, with chains of states drawn together to arcs that carry strings. The
transducer T copies symbols, makes one edit, and copies on. In A o T o A both copies of A stand in the same state until
the edit, so a composed state is (q, q) before it and (r, s) after it; it accepts where r and s both do. Of the places
where one edit can be written down, the first difference of the two words counts, so every pair is accepted on one path.

The vocabulary is dealt by initial states. A prefix of more than ``group_words`` words is hot. The words below a first
prefix that is not hot are one partition, composed whole. Edits at a hot prefix itself leave two words with the same rest
behind the edit: its words are dealt by the hash of that rest into partitions where only the edit in the initial state
counts. So no task gets more than about ``group_words`` words, whatever prefix they share, and no pair is left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.llm.common import as_bytes, batch_slices, ship, stored

#: Words of a partition, and the number of hot prefixes of one length that may be broadcast (partitions grow beyond it).
GROUP_WORDS, HOT_PREFIXES = 4096, 50_000
#: Letters of a word, A-Z already lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Distinct words that a task counts before it passes them on; code points by which a hot prefix is looked ahead at first.
HELD_WORDS, AHEAD = 300_000, 64


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    low, step = 0, 16
    while low < n and a[low : low + step] == b[low : low + step]:  # in growing steps, then one by one
        low += step
        step *= 2
    while step > 1:
        step //= 2
        if a[low : low + step] == b[low : low + step]:
            low += step
    return min(low, n)


class Acceptor:
    """Minimal acceptor of sorted, distinct words; ``arcs[q]`` maps a first symbol to (string, next state)."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[str, int]]] = []
        self._known: dict[tuple, int] = {}
        open_ = [[0, False, []]]  # states on the path of the last word: depth, final, arcs
        last = ""
        for w in words:
            k = common_prefix(last, w)
            while open_[-1][0] > k:
                depth, final, arcs = open_.pop()
                q = self._state(final, arcs)
                if open_[-1][0] < k:
                    open_.append([k, False, [(last[k:depth], q)]])
                else:
                    open_[-1][2].append((last[open_[-1][0] : depth], q))
            if len(w) == open_[-1][0]:
                open_[-1][1] = True
            else:
                open_.append([len(w), True, []])
            last = w
        while len(open_) > 1:
            depth, final, arcs = open_.pop()
            open_[-1][2].append((last[open_[-1][0] : depth], self._state(final, arcs)))
        self.start = self._state(open_[0][1], open_[0][2])
        del self._known

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        q = self._known.get(key)
        if q is None:
            q = self._known[key] = len(self.final)
            self.final.append(final)
            self.arcs.append({a[0][0]: a for a in arcs})
        return q


def _both(a: Acceptor, x: str, r: int, y: str, s: int) -> list[str]:
    """Strings accepted from behind ``x`` ... state r as well as from behind ``y`` ... state s (after the edit)."""
    found, todo = [], [(x, r, y, s, None)]
    while todo:
        x, r, y, s, link = todo.pop()
        m = min(len(x), len(y))
        if x[:m] != y[:m]:
            continue
        if m:
            link = (link, x[:m])
            x, y = x[m:], y[m:]
        if x or y:
            side, rest = (s, x) if x else (r, y)
            arc = a.arcs[side].get(rest[0])
            if arc:
                todo.append((x, r, *arc, link) if x else (*arc, y, s, link))
            continue
        if a.final[r] and a.final[s]:
            parts, at = [], link
            while at:
                at, part = at
                parts.append(part)
            found.append("".join(reversed(parts)))
        to = a.arcs[s]
        todo += [(*arc, *to[c], link) for c, arc in a.arcs[r].items() if c in to]
    return found


def edits_at(a: Acceptor, q: int) -> list[tuple[str, str]]:
    """Pairs of strings accepted from state q that differ in their first symbol or by an additional first symbol."""
    out = []
    arcs = list(a.arcs[q].items())
    for i, (c, (x, r)) in enumerate(arcs):
        for d, (y, s) in arcs[i + 1 :]:
            out += [(c + z, d + z) for z in _both(a, x[1:], r, y[1:], s)]
        # c inserted: the shorter string is empty or begins with another symbol
        if a.final[q] and len(x) == 1 and a.final[r]:
            out.append(("", c))
        heads = [x[1]] if len(x) > 1 else list(a.arcs[r])
        for d in heads:
            if d != c and d in a.arcs[q]:
                y, s = a.arcs[q][d]
                out += [(z, c + z) for z in _both(a, y, s, x[1:], r)]
    return out


def near_pairs(words: list[str], initial_only: bool = False) -> list[tuple[str, str]]:
    """All pairs of the sorted, distinct ``words`` one edit apart (``initial_only``: those that differ from their first
    symbol on), each once."""
    a = Acceptor(words)
    if initial_only:
        return edits_at(a, a.start)
    edits = [edits_at(a, q) for q in range(len(a.final))]
    fruit = [bool(e) for e in edits]
    for q in range(len(fruit)):  # states are numbered after those that they lead to
        fruit[q] = fruit[q] or any(fruit[r] for _, r in a.arcs[q].values())
    out, todo = [], [("", a.start)]
    while todo:
        path, q = todo.pop()
        out += [(path + u, path + v) for u, v in edits[q]]
        todo += [(path + x, r) for x, r in a.arcs[q].values() if fruit[r]]
    return out


def _group(table: pa.Table) -> pa.Table:
    """Per word of one partition with near words in it: their number and the one of largest n (ties: smallest)."""
    cols = table.select(["word", "n", "depth", "bucket", "buckets"]).to_pydict()
    count = dict(zip(cols["word"], cols["n"], strict=True))
    depth, bucket, buckets = cols["depth"][0], cols["bucket"][0], cols["buckets"][0]
    if buckets:
        head = cols["word"][0][:depth]
        pairs = []
        for u, v in near_pairs(sorted({w[depth:] for w in count}), True):
            rest = v[1:]
            if zlib.crc32(rest.encode()) % buckets == bucket:  # the pair's own partition, not one where both happen to be
                pairs.append((head + u, head + v))
    else:
        pairs = near_pairs(sorted(count))
    near: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for u, v in pairs:
        for x, y in ((u, v), (v, u)):
            near[x] += 1
            to = (-count[y], y)
            if x not in best or to < best[x]:
                best[x] = to
    words = list(near)
    return pa.table({
        "word": pa.array(words, pa.string()), "n_near": pa.array([near[w] for w in words], pa.int64()),
        "best_n": pa.array([-best[w][0] for w in words], pa.int64()), "best": pa.array([best[w][1] for w in words], pa.string()),
    })


def _hot_prefixes(words: DataFrame, limit: int) -> list[tuple[int, int, dict[str, tuple[int, int]]]]:
    """Levels (depth, branch, {prefix: (words, where they part)}) of the prefixes with more than ``limit`` words.

    ``branch`` is the first place where the words of some prefix of the level part; the next level lies one beyond.
    Prefixes of one length are fewer than words / limit.
    """
    levels, depth, above, ahead = [], 0, None, AHEAD
    spark = words.sparkSession
    while True:
        src = words.where(F.length("word") >= depth).withColumn("prefix", F.substring("word", 1, depth))
        if above:
            parents = spark.createDataFrame([(p,) for p in above], "parent string")
            src = src.withColumn("parent", F.substring("word", 1, len(next(iter(above))))).join(F.broadcast(parents), "parent", "left_semi")
        look = F.substring("word", depth + 1, ahead)
        hot = src.groupBy("prefix").agg(F.count("*").alias("n"), F.min(look).alias("low"), F.max(look).alias("high")).where(F.col("n") > limit).collect()
        if not hot:
            return levels
        found = {r["prefix"]: (r["n"], depth + common_prefix(r["low"], r["high"])) for r in hot}
        branch = min(b for _, b in found.values())
        levels.append((depth, branch, found))
        ahead = 4 * ahead if branch == depth + ahead else AHEAD  # a long common prefix: look further
        depth, above = branch + 1, found


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` (word, n; distinct words) that has near words.

    Near: one inserted, deleted or replaced code point. ``best`` is the near word of largest n, of equal ones the
    smallest in code-point order.
    """
    spark = words.sparkSession
    ship(spark)
    total = words.count()
    limit = max(group_words, -(-total // HOT_PREFIXES))
    levels = _hot_prefixes(words, limit)
    schema = "word string, n_near bigint, best_n bigint, best string"
    base = words.select("word", "n")
    if not levels:
        rows = base.select("word", "n", F.lit(0).alias("depth"), F.lit(0).alias("bucket"), F.lit(0).alias("buckets"), F.lit("").alias("key"))
    else:
        hot = [(i, p, b == branch, -(-4 * n // limit)) for i, (_, branch, found) in enumerate(levels) for p, (n, b) in found.items()]
        table = spark.createDataFrame(hot, "level int, key string, parts boolean, buckets int")
        depths = [d for d, _, _ in levels] + [levels[-1][1] + 1]
        of_level = F.array(*[F.lit(d) for d in depths])
        each = base.select("word", "n", F.posexplode(of_level).alias("level", "depth"))
        each = each.where((F.col("depth") == 0) | (F.length("word") >= F.element_at(F.array(*[F.lit(d) for d in [0, *depths[:-1]]]), F.col("level") + 1)))
        each = each.withColumn("key", F.expr("substring(word, 1, depth)")).withColumn("full", F.length("word") >= F.col("depth"))
        before = F.element_at(F.array(*[F.lit(d) for d in [0, *depths[:-1]]]), F.col("level") + 1)
        each = each.withColumn("above", F.substring(F.col("word"), F.lit(1), before))
        parent = table.select((F.col("level") + 1).alias("level"), F.col("key").alias("above"), F.lit(True).alias("in_hot"))
        # broadcasts: at most HOT_PREFIXES prefixes a level
        each = each.join(F.broadcast(table), ["level", "key"], "left").join(F.broadcast(parent), ["level", "above"], "left")
        each = each.where((F.col("level") == 0) | F.col("in_hot"))
        leaf = each.where(F.col("buckets").isNull() & F.col("full"))
        leaf = leaf.select("word", "n", "depth", F.lit(0).alias("bucket"), F.lit(0).alias("buckets"), "key")
        branch_of = F.element_at(F.array(*[F.lit(b) for _, b, _ in levels]), F.col("level") + 1)
        inner = each.where("parts").withColumn("depth", branch_of).withColumn("key", F.expr("substring(word, 1, depth)"))

        def of(rest: str):
            return (F.crc32(F.expr(rest).cast("binary")) % F.col("buckets")).cast("int")

        longer = F.when(F.length("word") > F.col("depth"), of("substring(word, depth + 2)"))
        inner = inner.withColumn("bucket", F.explode(F.array_distinct(F.array_compact(F.array(longer, of("substring(word, depth + 1)"))))))
        rows = leaf.unionByName(inner.select("word", "n", "depth", "bucket", "buckets", "key"))
    found = rows.groupBy("key", "depth", "bucket", "buckets").applyInArrow(_group, schema)
    first = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best"))).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    return found.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form; no cycles): the end of the chain, by pointer doubling.

    A chain of k steps takes log2(k) rounds; each joins the pointers with themselves and is written down.
    """
    known = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(known.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        known = step.select("word", "root")
        if step.where("moved").isEmpty():
            return known


def group_variants(words: DataFrame, times: int = 10, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n; distinct words).

    ``form`` is the near word of largest n if that is at least ``times`` the word's n, else null; ``root`` the end of the
    chain of forms (the word itself without one). With ``times`` of 2 or more, n grows along a chain, so there are no cycles.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    near = near_words(words, group_words)
    all_ = words.select("word", "n").join(near, "word", "left")
    holds = F.col("best_n") >= times * F.col("n")
    all_ = stored(
        all_.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("best")).alias("form"), F.when(holds, F.col("best_n")).alias("form_n")),
        "spelling",
    )
    ends = roots(all_.where(F.col("form").isNotNull()))
    out = all_.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _count(min_chars: int, drop_one_in: int | None):
    find = re.compile(f"[{LETTERS}]{{{min_chars},}}").findall

    def record(total: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        total: dict[str, int] = {}
        crc = zlib.crc32
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    runs = Counter(find(text.lower().decode("utf-8", "replace")))
                    if not drop_one_in:
                        for w, k in runs.items():
                            total[w] = total.get(w, 0) + k
                        continue
                    seed = crc(f"{doc}:".encode())
                    for w, k in runs.items():
                        h = crc(w.encode(), seed)
                        if not h % drop_one_in:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                            if len(w) < min_chars:
                                continue
                        total[w] = total.get(w, 0) + k
                if len(total) >= HELD_WORDS:
                    yield record(total)
                    total = {}
        yield record(total)

    return run


def vocabulary(docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_one_in: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters (A-Z lower-cased, U+00C0 to U+00FF) of ``min_chars`` code points or more in whole texts
    that occur ``min_count`` times overall.

    ``drop_one_in`` plants misspellings: where it divides the unsigned CRC-32 h of ``<id>:<run>`` (a null id: empty), the
    code point h % length of the run goes. A null text has no words. Tasks count before the shuffle; other columns are not read.
    """
    ship(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), as_bytes(text_col).alias("text"))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
    parts = src.mapInArrow(_count(min_chars, drop_one_in), schema)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def spelling_variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_one_in: int | None = None, times: int = 10, id_col: str = "doc_id", text_col: str = "text", group_words: int = GROUP_WORDS) -> DataFrame:
    """``group_variants`` of the ``vocabulary`` of ``docs``, which is counted once and written down."""
    words = stored(vocabulary(docs, min_chars, min_count, drop_one_in, id_col, text_col), "spelling-words")
    return group_variants(words, times, group_words)
