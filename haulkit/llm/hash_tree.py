"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards.  A key descends it: at each level every child
draws -ln(u) / weight, u being a number in (0, 1) that the key and the child's name
alone fix, and the smallest draw wins.  So a child gets its share of the keys by weight,
and a key's place depends on nothing but the key and the tree.

A change of one weight moves keys between the children of its own ancestors only:
draws of all other children stay as they were.  ``Tree.grown`` adds a shard as a region
of its own, so the one draw that is new decides: a key moves into the new shard or
stays where it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulkit.llm.shared import materialise, text_of

#: Copies of one row that a task lists together.
CHUNK = 1 << 16
LEVELS = ("region", "rack", "shard")


def as_key(column: Column) -> Column:
    """The key as text, null as ''."""
    return F.coalesce(column.cast("string"), F.lit(""))


def draw(key: Column, name: Column, weight: Column) -> Column:
    """An exponential draw of rate ``weight``, from the first 52 bits of md5(key:name)."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), name).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


@dataclass(frozen=True)
class Tree:
    """Leaves (region, rack, shard, weight); shards of weight 0 get no keys.  The list of leaves travels with the
    plan: some thousands of shards at most, whatever the data."""

    leaves: tuple[tuple[int, int, int, float], ...]

    def __post_init__(self):
        if len({leaf[2] for leaf in self.leaves}) < len(self.leaves):
            raise ValueError("a shard stands twice in the tree")
        if any(leaf[3] < 0 for leaf in self.leaves) or not any(leaf[3] for leaf in self.leaves):
            raise ValueError("weights must not be negative, and one must be positive")

    @classmethod
    def regular(cls, shards: int, racks: int = 3, per_rack: int = 4) -> Tree:
        """Shards 0 to shards - 1 of weight 1, ``per_rack`` to a rack and ``racks`` to a region."""
        return cls(tuple((s // (racks * per_rack), s // per_rack % racks, s, 1.0) for s in range(shards)))

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree and one more shard, which opens a region: keys move into that shard only."""
        return Tree((*self.leaves, (max(leaf[0] for leaf in self.leaves) + 1, 0, max(leaf[2] for leaf in self.leaves) + 1, weight)))

    def weighed(self, shard: int, weight: float) -> Tree:
        """The tree with another weight of one shard."""
        return Tree(tuple((*leaf[:3], weight if leaf[2] == shard else leaf[3]) for leaf in self.leaves))

    def levels(self) -> list[list[list[tuple[str, float, int]]]]:
        """Per level, for each node of the level above, its children (name, weight, number within the level)."""
        above, out = {(): 0}, []
        for depth in range(1, len(LEVELS) + 1):
            weights: dict[tuple[int, ...], float] = {}
            for leaf in self.leaves:
                if leaf[3]:
                    weights[leaf[:depth]] = weights.get(leaf[:depth], 0.0) + float(leaf[3])
            below = {path: k for k, path in enumerate(weights)}
            children: list[list[tuple[str, float, int]]] = [[] for _ in above]
            for path, k in below.items():
                children[above[path[:-1]]].append((".".join(map(str, path)), weights[path], k))
            out.append(children)
            above = below
        self_shards = [path[2] for path in above]
        out[-1] = [[(name, w, self_shards[k]) for name, w, k in kids] for kids in out[-1]]
        return out

    def place(self, key: Column) -> Column:
        """The shard of a key (text)."""
        node = F.lit(0)
        for children in self.levels():
            table = F.array(*(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(k).alias("child"))
                                        for n, w, k in kids)) for kids in children))
            drawn = F.transform(F.element_at(table, node + 1),
                                lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["child"].alias("child")))
            node = F.array_min(drawn)["child"]
        return node.cast("int")


def slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (shard, copies, place and others), each ``copies`` times, with slot: 0, 1, 2... in each shard.

    place is text of hex digits that spreads evenly; slots follow it, ties by ``order``.  No shard is
    numbered in one task: its rows fall into 4096 bins by place, bins start at the sum of
    those before them, and only a bin is sorted.  Copies are one row until they are numbered.
    """
    binned = rows.withColumn("bin", F.substring("place", 1, 3))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (binned.groupBy("shard", "bin").agg(F.sum("copies").alias("n"))
              .select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("shard", "bin").orderBy("place", *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = materialise(binned.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0)))
                         .join(starts, ["shard", "bin"])
                         .withColumn("first", F.col("start") + F.col("before")).drop("bin", "before", "start"), "shard-slots")

    def listed(df: DataFrame, start: Column, end: Column) -> DataFrame:
        return df.withColumn("nth", F.explode(F.sequence(start, end))).withColumn("slot", F.col("first") + F.col("nth")).drop("nth")

    few = listed(placed.filter(F.col("copies") <= CHUNK), F.lit(0).cast("long"), F.col("copies") - 1)
    many = (placed.filter(F.col("copies") > CHUNK)
            .withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(CHUNK).cast("long"))))
            .repartition("place", "from"))
    many = listed(many, F.col("from"), F.least(F.col("from") + CHUNK, F.col("copies")) - 1).drop("from")
    return few.unionByName(many).drop("first")


def assign_shards(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, size, text_crc32, law, shard, slot, grown_shard.

    size is 8 more than the UTF-8 bytes of the text; a null text counts as empty.  The id as
    text is the key (a null id: ''), so shards depend on ids and the tree alone, and rows
    that repeat an id share a shard.  Slots follow md5(key:size:crc32), so they depend on the rows
    alone too; rows alike in id, size and checksum take neighbouring slots.  grown_shard is
    the shard in the ``grown`` tree, null without one.  An empty table gives an empty one;
    other columns of ``docs`` are not read.
    """
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    rows = rows.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    key = as_key(F.col("id"))
    rows = materialise(rows.select(
        "id", "size", "text_crc32", "copies", tree.place(key).alias("shard"),
        (grown.place(key) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.md5(F.concat_ws(":", key, "size", "text_crc32").cast("binary")).alias("place")), "shard-rows")
    return slots(rows, ["id", "size", "text_crc32"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, tree: Tree, path: str, key: str = "doc_id", files: int = 1) -> None:
    """Write whole rows to ``path``/shard=N/, each shard in about ``files`` files that split it by another hash of the row.

    A column of ``docs`` named shard raises, as the folders would hide it.
    """
    if "shard" in docs.columns:
        raise ValueError("docs has a column 'shard'")
    part = F.pmod(F.xxhash64(*docs.columns), F.lit(files))
    (docs.withColumns({"shard": tree.place(as_key(F.col(key))), "__part": part}).repartition("shard", "__part")
     .drop("__part").write.partitionBy("shard").parquet(path))


def op12_shards(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 23 by doc_id, of 2 regions with 3 racks of 4 shards, and where one more shard would put them."""
    tree = Tree.regular(24)
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), tree, tree.grown())


#: CRC-32 of a list of bytes ``b``: the table of its 256 steps is made by rule.
CRC_TABLE = """tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i)))"""
CRC_OF = "xor(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT"
BYTES_OF = "list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda x: ('0x' || x)::BIGINT)"

OP12_SQL = f"""
WITH {CRC_TABLE},
b AS (SELECT doc_id, coalesce(text, '') AS x, {BYTES_OF.format("coalesce(text, '')")} AS b FROM documents),
d AS (SELECT doc_id, (strlen(x) + 8)::BIGINT AS size, {CRC_OF} AS text_crc32, coalesce(doc_id::VARCHAR, '') AS key FROM b, tab),
leaf AS (SELECT s::INTEGER AS shard, s // 12 AS region, s // 4 % 3 AS rack FROM range(25) r(s)),
node AS (SELECT 1 AS level, '' AS up, region::VARCHAR AS name, count(*) AS weight, min(shard) AS shard FROM leaf GROUP BY region
  UNION ALL SELECT 2, region::VARCHAR, region || '.' || rack, count(*), min(shard) FROM leaf GROUP BY region, rack
  UNION ALL SELECT 3, region || '.' || rack, region || '.' || rack || '.' || shard, 1, shard FROM leaf),
drawn AS (SELECT k.key, n.level, n.up, n.name, n.shard,
    -ln((('0x' || substr(md5(k.key || ':' || n.name), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / n.weight AS draw
  FROM (SELECT DISTINCT key FROM d) k, node n),
one AS (SELECT key, arg_min(name, draw) AS name, arg_min(name, draw) FILTER (name <> '2') AS old FROM drawn WHERE level = 1 GROUP BY key),
two AS (SELECT o.key, arg_min(w.name, w.draw) AS rack FROM one o JOIN drawn w ON w.key = o.key AND w.level = 2 AND w.up = o.old GROUP BY o.key),
three AS (SELECT o.key, arg_min(w.shard, w.draw) AS shard FROM two o JOIN drawn w ON w.key = o.key AND w.level = 3 AND w.up = o.rack GROUP BY o.key)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(key || ':' || size || ':' || text_crc32), doc_id) - 1 AS slot,
  CASE WHEN name = '2' THEN 24 ELSE shard END::INTEGER AS grown_shard
FROM d JOIN one USING (key) JOIN three USING (key)
"""
