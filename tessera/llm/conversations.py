"""Prefix trie of rebuilt conversations, by fingerprints that compose."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.lineage import cut, discard

#: Primes and bases of the fingerprints: a sequence t_1 .. t_n has sum(t_i * base^(i-1)) modulo each prime, 124 bits together.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483563)
BASES = (1103515245, 69069069, 1664525017, 1812433253)
#: Most turns that are taken from the base conversation, and conversations that share a base.
HEADS, FAMILY = 4, 20
#: Ids that are joined into one piece of text before they are hashed in order.
PIECE = 512

_F = [f"f{k}" for k in range(len(PRIMES))]


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 (hex) of a turn; the role's length tells where the text begins."""
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _times(base: np.ndarray, exponent: np.ndarray, prime: int) -> np.ndarray:
    """base^exponent modulo a prime, element by element."""
    out, square = np.ones(len(exponent), np.int64), base % prime
    while exponent.any():
        out = np.where(exponent & 1, out * square % prime, out)
        square, exponent = square * square % prime, exponent >> 1
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a sorted partition: each turn's place in its conversation and the fingerprints of all turns up to it."""
    last, place, held = None, 0, [0] * len(PRIMES)
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        digest = batch.column(1).to_pylist()
        parts = np.array([[int(d[8 * k : 8 * k + 8], 16) for k in range(len(PRIMES))] for d in digest], np.int64)
        start = np.concatenate(([0], np.flatnonzero(conv[1:] != conv[:-1]) + 1))
        size = np.diff(np.append(start, len(conv)))
        goes_on = conv[0] == last
        at = np.arange(len(conv)) - np.repeat(start, size)
        at[: size[0]] += place if goes_on else 0
        columns = []
        for k, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
            sums = np.cumsum(parts[:, k] % prime * _times(np.full(len(at), base), at, prime) % prime)
            before = np.repeat(sums[start] - (sums - np.concatenate(([0], sums[:-1])))[start], size)
            sums = sums - before
            sums[: size[0]] += held[k] if goes_on else 0
            columns.append(sums % prime)
            held[k] = int(columns[-1][-1])
        last, place = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(at + 1), *map(pa.array, columns), *batch.columns[1:]], names=["conv_id", "i", *_F, "digest", "words", "pid"])


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, i, f0.., digest, words): the i-th turn, and the fingerprints of turns 1 to i.

    Turns are sorted by range, so a conversation with very many of them lies in several partitions; each is summed up
    where it lies, and what stands before a partition (at most two rows of each go to the driver) is composed with it.
    """
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).where("conv_id is not null")
    t = t.withColumn("digest", turn_digest(F.col("role"), F.col("text")))
    t = t.withColumn("words", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    t = t.repartitionByRange(*order, F.rand(5)).sortWithinPartitions(*order)
    t = t.select("conv_id", "digest", "words", F.spark_partition_id().alias("pid"))
    schema = f"conv_id long, i long, {', '.join(f'{f} long' for f in _F)}, digest string, words long, pid int"
    local = cut(t.mapInArrow(_scan, schema), "turns")
    edges = local.groupBy("pid").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("final"))
    at_edge = local.join(F.broadcast(edges), "pid").where("conv_id in (first, final)")  # one row a partition
    sums = at_edge.groupBy("conv_id", "pid").agg(F.max(F.struct("i", *_F)).alias("s")).orderBy("conv_id", "pid").collect()
    carried, before = [], None
    for r in sums:
        n, *have = r["s"]
        if before and before[0] == r["conv_id"]:
            count, held = before[1:]
            power = [pow(b, count, p) for b, p in zip(BASES, PRIMES, strict=True)]
            carried.append((r["conv_id"], r["pid"], count, *held, *power))
            n, have = n + count, [(x + y * m) % p for x, y, m, p in zip(held, have, power, PRIMES, strict=True)]
        before = r["conv_id"], n, have
    if not carried:
        return local.drop("pid")
    names = ["conv_id", "pid", "c_i", *(f"c_{f}" for f in _F), *(f"m_{f}" for f in _F)]
    types = ", ".join(f"{c} {'int' if c == 'pid' else 'long'}" for c in names)
    carry = local.sparkSession.createDataFrame(carried, types)
    both = local.join(F.broadcast(carry), ["conv_id", "pid"], "left")  # at most two rows a partition
    moved = [F.coalesce((F.col(f"c_{f}") + F.col(f) * F.col(f"m_{f}")) % p, F.col(f)).alias(f) for f, p in zip(_F, PRIMES, strict=True)]
    return both.select("conv_id", (F.col("i") + F.coalesce("c_i", F.lit(0))).alias("i"), *moved, "digest", "words")


def rebuilt_prefixes(prefixes: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, f0.., digest, words): all prefixes of all rebuilt conversations, the empty one included.

    Conversation c takes the first h turns of c - c % 20 and goes on with its own after its first h; h = crc32(c) % 4.
    With H the fingerprints, b the base and g the turns taken, the i-th own turn ends the prefix H_b(g) + (H_c(i) - H_c(h)) * base^(g - h):
    texts are neither copied nor read. digest and words are those of the prefix's last turn.
    """
    firsts = prefixes.where(F.col("i") < HEADS).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("i", *_F, "digest", "words"))).alias("first"))  # at most three a conversation
    own = prefixes.where("i = 1").select("conv_id").join(firsts, "conv_id").withColumns({
        "h": F.crc32(F.col("conv_id").cast("string")) % HEADS, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = firsts.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("first").alias("taken"))
    c = own.join(heads, "base", "left").withColumn("taken", F.expr("slice(coalesce(taken, array()), 1, cast(h AS int))"))
    c = c.withColumn("g", F.size("taken").cast("long"))
    at = lambda xs, n, f: F.coalesce(F.get(xs, (F.col(n) - 1).cast("int"))[f], F.lit(0))
    info = c.select("conv_id", "h", "g", "taken", *(at(F.col("taken"), "g", f).alias(f"b_{f}") for f in _F), *(at(F.col("first"), "h", f).alias(f"h_{f}") for f in _F))
    info = cut(info, "info")
    roots = info.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(f) for f in _F), F.lit("").alias("digest"), F.lit(0).cast("long").alias("words"))
    head = info.select("conv_id", F.explode("taken").alias("t")).select("conv_id", F.col("t.i").alias("depth"), *(F.col(f"t.{f}") for f in _F), "t.digest", "t.words")
    shift = lambda k: F.element_at(F.array(*(F.lit(pow(BASES[k], -n, PRIMES[k])) for n in range(HEADS))), (F.col("h") - F.col("g") + 1).cast("int"))
    rest = prefixes.join(info.drop("taken"), "conv_id").where("i > h")
    rest = rest.select("conv_id", (F.col("g") + F.col("i") - F.col("h")).alias("depth"), *(
        F.pmod(F.col(f"b_{f}") + F.pmod(F.col(f) - F.col(f"h_{f}"), F.lit(p)) * shift(k), F.lit(p)).alias(f)
        for k, (f, p) in enumerate(zip(_F, PRIMES, strict=True))), "digest", "words")
    return roots.unionByName(head).unionByName(rest)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order: one piece at a time is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for rep, depth, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (rep, depth) != node:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (rep, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if done:
            yield _digests(done)
    if node:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    rep, depth, ends = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(depth, pa.int64()), pa.array(ends)], names=["rep", "depth", "ends_sha256"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text), see :func:`rebuilt_prefixes`.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    1. Prefixes with equal fingerprints are one node. The digest of the last turn, which each prefix refers to, must be the same for
       all of a node's members; as fingerprints minus their last turn are their parents', whole sequences are equal
       when that holds at every node. Otherwise the query raises.
    2. A node is named by (smallest member, depth); its parent is where that member stands one turn earlier.
    3. Sums over subtrees go up by doubled distances: log2(longest conversation) rounds.
    4. The ids that end at a node are joined in pieces of a range of ids each, and hashed piece by piece.

    Turns are in order of turn (null first), then role and text; rows repeated in full count each. Null role and text are
    empty; rows with a null conv_id are left out; a conversation whose rebuilt form has no turn is a member of the root. Very
    long conversations and texts are never held whole. Extra columns are not read. An empty table gives no rows.
    """
    prefixes = turn_prefixes(turns)
    members = cut(rebuilt_prefixes(prefixes), "members")
    same = F.when(F.min("digest") == F.max("digest"), F.min("words")).otherwise(F.raise_error(F.lit("two sequences of turns have the same fingerprints")).cast("long"))
    nodes = cut(members.groupBy("depth", *_F).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), same.alias("words")), "nodes")
    placed = cut(members.join(nodes.select("depth", *_F, "rep"), ["depth", *_F]).select("conv_id", "depth", "rep"), "placed")
    discard(members)

    def above(of: DataFrame, distance: int) -> DataFrame:
        """``of`` (rep, depth, ...) with ``up``: the smallest member of the node ``distance`` turns earlier."""
        p = placed.select(F.col("conv_id").alias("rep"), (F.col("depth") + distance).alias("depth"), F.col("rep").alias("up"))
        return of.join(p, ["rep", "depth"], "left")

    tree = above(nodes.select("rep", "depth", "n_convs", "words"), 1)
    children = tree.where("depth > 0").groupBy(F.col("up").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    tree = cut(tree.join(children, ["rep", "depth"], "left").fillna(0, ["n_children"]), "tree")
    sums = tree.select("rep", "depth", "up", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    deepest, distance, written = tree.agg(F.max("depth")).first()[0] or 0, 1, []
    while distance <= deepest:
        more = sums.where(F.col("depth") >= distance).groupBy(F.col("up").alias("rep"), (F.col("depth") - distance).alias("depth")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        sums = sums.drop("up").join(more, ["rep", "depth"], "left").select(
            "rep", "depth", *((F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("n_leaves", "more_leaves"), ("saved_tokens", "more_saved"))))
        distance *= 2
        sums = cut(above(sums, distance) if distance <= deepest else sums, "sums")
        discard(*written)
        written = [sums]

    last = placed.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = placed.join(last, ["conv_id", "depth"]).groupBy("rep", "depth", F.expr(f"conv_id div {PIECE}").alias("k")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("piece"))  # at most PIECE ids
    ends = ends.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "k").select("rep", "depth", "piece")
    ends = ends.mapInArrow(_hashed, "rep long, depth long, ends_sha256 string")
    out = tree.select("rep", "depth", "up", "n_convs", "n_children").join(sums.select("rep", "depth", "n_leaves", "saved_tokens"), ["rep", "depth"]).join(ends, ["rep", "depth"], "left")
    return out.select(
        F.col("rep").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


TRIE_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ord(x), 0, 0, 0, 0, 0, 0, 0])) AS bits FROM t),
h AS (SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295, list_transform(bits, lambda x: CAST(x AS BIGINT))),
  lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295) % 4 AS h FROM ids),
r AS (SELECT h.conv_id, t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.i <= h.h
  UNION ALL SELECT h.conv_id, 1000000000 + t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.i > h.h),
g AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
  sha256(role || chr(0) || text) AS x FROM r),
p AS (SELECT conv_id, d, words, string_agg(x, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM g UNION ALL SELECT conv_id, 0, 0, '' FROM h),
n AS (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, count(*) FILTER (WHERE d = deepest) AS n_ends,
  string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = deepest) AS ends
  FROM p JOIN (SELECT conv_id, max(d) AS deepest FROM p GROUP BY 1) USING (conv_id) GROUP BY 1, 2),
c AS (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path)),
s AS (SELECT left(path, 64 * e) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT path, n_convs, words, n_children, unnest(range(0, d + 1)) AS e FROM v) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s USING (path) LEFT JOIN n u ON v.d > 0 AND u.path = left(v.path, 64 * (v.d - 1))
"""
