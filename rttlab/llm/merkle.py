"""Merkle manifest of a dataset: leaves, roots, inclusion proofs and their check.

Slot pivot: conditional aggregates spread the children of each parent into as
many columns as the fanout. The columns, concatenated, give the parent's
digest; without a child's own column they are its siblings. Levels are built
upwards, an eighth of the rows each; the siblings of all ancestors are then
handed down level by level, and reach the documents as one row for each run of
leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rttlab.session import persist_table

from .crc_sql import crc_ctes
from .order import positions

FANOUT = 8
TAMPERED_OF = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """A field as it enters a leaf: ``-`` for null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def _slots(fanout: int) -> list[str]:
    return [f"s{i}" for i in range(fanout)]


def _joined(names: list[str]) -> Column:
    return F.concat(F.lit(""), *[F.coalesce(F.col(n), F.lit("")) for n in names])


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """(grp, pos, digest, level_size) -> one row for each run of ``fanout`` nodes, its children in slot columns."""
    slot = F.col("pos") % fanout
    pivot = nodes.groupBy("grp", F.floor(F.col("pos") / fanout).alias("pos")).agg(
        *[F.max(F.when(slot == i, F.col("digest"))).alias(name) for i, name in enumerate(_slots(fanout))],
        F.ceil(F.max("level_size") / fanout).alias("level_size"))
    return pivot.withColumn("digest", F.sha2(_joined(_slots(fanout)), 256))


def _levels(nodes: DataFrame, largest: int, fanout: int) -> list[DataFrame]:
    """Written parent tables from the leaves' parents up to the highest level that any group has."""
    out = []
    while largest > 1:
        nodes = persist_table(_parents(nodes.filter("level_size > 1"), fanout), f"merkle-level-{len(out) + 1}")
        out.append(nodes)
        largest = -(-largest // fanout)
    return out


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(grp, digest): the one node that remains of each group."""
    tops = leaves.filter("level_size = 1").select("grp", "digest")
    for level in levels:
        tops = tops.unionByName(level.filter("level_size = 1").select("grp", "digest"))
    return tops


def _beside(fanout: int) -> tuple[Column, Column]:
    """Siblings left and right of the slot in column ``slot``: all slot columns but the own one."""
    names = _slots(fanout)
    left = right = None
    for i in range(fanout):
        here = F.col("slot") == i
        left = F.when(here, _joined(names[:i])) if left is None else left.when(here, _joined(names[:i]))
        right = F.when(here, _joined(names[i + 1:])) if right is None else right.when(here, _joined(names[i + 1:]))
    return left, right


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """Every child of ``parents`` with the siblings of all its ancestors and itself (``lefts``, ``rights``)."""
    left, right = _beside(fanout)
    here = F.element_at(F.array(*_slots(fanout)), F.col("slot") + 1)
    return (parents.select("*", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("slot"))
            .withColumn("digest", here).filter("digest is not null")
            .select("grp", (F.col("pos") * fanout + F.col("slot")).alias("pos"), "digest", "subroot", "root",
                    F.concat(F.array(left), "lefts").alias("lefts"), F.concat(F.array(right), "rights").alias("rights")))


def _above(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame | None:
    """The leaves' parents (slot columns) with ``lefts`` and ``rights`` of their own ancestors.

    ``tops`` has grp, subroot, root and the arrays above each group's top node.
    """
    handed = None  # nodes of the level in hand with what is above them
    for level in reversed(levels):
        top = (level.filter("level_size = 1").select("grp", "pos", *_slots(fanout))
               .join(tops, F.col("grp").eqNullSafe(F.col("t_grp"))).drop("t_grp"))
        if handed is not None:
            below = level.filter("level_size > 1").select(
                F.col("grp").alias("l_grp"), F.col("pos").alias("l_pos"), *_slots(fanout))
            top = top.unionByName(
                below.join(handed, F.col("l_grp").eqNullSafe(F.col("grp")) & (F.col("l_pos") == F.col("pos")))
                .select("grp", "pos", *_slots(fanout), "subroot", "root", "lefts", "rights"))
        parents = persist_table(top, "merkle-above")
        handed = _children(parents, fanout)
    return parents if levels else None


def merkle_tree(leaves: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Each leaf with its tree and its proof.

    ``leaves`` has ``grp`` (string), ``ord`` (any orderable key), ``digest``
    and further columns, which are kept. A group's leaves ascend by (ord,
    digest), nulls first; while several nodes remain, every ``fanout`` consecutive ones
    become the digest of their concatenation. The remaining subroots, ordered
    by group (null first, bytewise), likewise give the root. Adds ``subroot``,
    ``root`` and ``lefts``, ``rights``: the concatenated siblings on either
    side, level by level from the leaf to the root.

    Repeated rows are leaves of their own; which of them takes which place does
    not matter. An empty table gives an empty table.
    """
    order = [F.col("ord").asc_nulls_first(), F.col("digest")]
    placed = persist_table(positions(leaves, ["grp"], order, "pos", "level_size"), "merkle-leaves")
    largest = placed.agg(F.max("level_size")).head()[0] or 0
    nodes = placed.select("grp", "pos", "digest", "level_size")
    levels = _levels(nodes, largest, fanout)

    # The subroots are the leaves of the tree above, one group of all.
    subroots = _tops(nodes, levels).select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    upper = persist_table(positions(subroots, ["grp"], [F.col("member").asc_nulls_first()], "pos", "level_size"),
                          "merkle-subroots")
    groups = upper.agg(F.max("level_size")).head()[0] or 0
    upper_nodes = upper.select("grp", "pos", "digest", "level_size")
    upper_levels = _levels(upper_nodes, groups, fanout)
    none = F.array().cast("array<string>")
    root = _tops(upper_nodes, upper_levels).select(
        F.col("grp").alias("t_grp"), F.lit("").alias("subroot"), F.col("digest").alias("root"),
        none.alias("lefts"), none.alias("rights"))
    parents = _above(upper_levels, root, fanout)
    members = upper.select("member", "pos", F.col("digest").alias("own"))
    if parents is None:
        tops = members.select(F.col("member").alias("t_grp"), F.col("own").alias("subroot"), F.col("own").alias("root"),
                              none.alias("lefts"), none.alias("rights"))
    else:
        tops = members.join(_children(parents, fanout).drop("subroot"), "pos").select(
            F.col("member").alias("t_grp"), F.col("own").alias("subroot"), "root", "lefts", "rights")
    tops = persist_table(tops, "merkle-tops")

    kept = [c for c in leaves.columns if c != "grp"]
    alone = (placed.filter("level_size = 1").join(tops, F.col("grp").eqNullSafe(F.col("t_grp")))
             .select("grp", *kept, "subroot", "root", "lefts", "rights"))
    parents = _above(levels, tops, fanout)
    if parents is None:
        return alone
    left, right = _beside(fanout)
    runs = parents.select(F.col("grp").alias("r_grp"), F.col("pos").alias("r_pos"), *_slots(fanout), "subroot", "root",
                          "lefts", "rights")
    several = (placed.filter("level_size > 1").withColumn("slot", F.col("pos") % fanout)
               .join(runs, F.col("grp").eqNullSafe(F.col("r_grp")) & (F.floor(F.col("pos") / fanout) == F.col("r_pos")))
               .select("grp", *kept, "subroot", "root", F.concat(F.array(left), "lefts").alias("lefts"),
                       F.concat(F.array(right), "rights").alias("rights")))
    return several.unionByName(alone)


def proof_text() -> Column:
    """All siblings of a leaf, level by level to the root, left to right."""
    return F.concat_ws("", F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)))


def folded(leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of its place."""
    return F.aggregate(F.arrays_zip(F.col("lefts").alias("lefts"), F.col("rights").alias("rights")), leaf,
                       lambda own, beside: F.sha2(F.concat(beside["lefts"], own, beside["rights"]), 256))


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group: str = "lang",
             tampered: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof``, ``proof_sha256``, ``folded_root``
    and ``verified``.

    A leaf is the digest of ``fields`` (nulls are told from empty texts); one
    tree per ``group`` (null is a group), one over the groups. ``proof`` is the
    text of the siblings. ``tampered`` names fields whose given value replaces
    the original when the document is checked: ``folded_root`` comes from that
    leaf and the untampered siblings, ``verified`` says whether it is the root.
    Other columns of the input are not read, so their names cannot clash.
    """
    tampered = tampered or {}
    leaves = docs.select(F.col(group).cast("string").alias("grp"), F.col(id_col).alias("ord"),
                         record_digest([F.col(f) for f in fields]).alias("digest"),
                         record_digest([tampered.get(f, F.col(f)) for f in fields]).alias("seen"))
    tree = merkle_tree(leaves, fanout)
    return (tree.select(F.col("ord").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root",
                        proof_text().alias("proof"), folded(F.col("seen")).alias("folded_root"))
            .withColumn("proof_sha256", F.sha2("proof", 256))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_merkle_manifest(spark, sf: str) -> DataFrame:
    """Manifest of all rows of ``documents``; every third id's text is checked in lower case."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_OF == 0
    lower = F.when(hit, F.translate(F.col("text"), UPPER, LOWER)).otherwise(F.col("text"))
    out = manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered={"text": lower})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _sql() -> str:
    def field(name: str) -> str:
        text = f"cast({name} as varchar)"
        return f"coalesce(strlen({text})::varchar || ':' || {text}, '-')"

    first = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
with recursive ids as (select cast(doc_id as varchar) as s from documents), {crc_ctes("ids")},
rows_ as (
  select d.doc_id, d.lang, sha256({first} || {field("d.text")}) as leaf,
         sha256({first} || {field(f"case when c.crc % {TAMPERED_OF} = 0 then translate(d.text, '{UPPER}', '{LOWER}') else d.text end")}) as seen
  from documents d left join crc c on c.s = cast(d.doc_id as varchar)),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
                  count(*) over (partition by lang) as n from rows_),
tree as (
  select lang, 0 as level, pos, leaf as digest, n from placed
  union all
  select lang, level + 1, pos // {FANOUT}, sha256(string_agg(digest, '' order by pos)), (n + {FANOUT} - 1) // {FANOUT}
  from tree where n > 1 group by lang, level, pos // {FANOUT}, n),
tops as (select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
         from tree where n = 1),
upper_ as (
  select 0 as level, pos, subroot as digest, n from tops
  union all
  select level + 1, pos // {FANOUT}, sha256(string_agg(digest, '' order by pos)), (n + {FANOUT} - 1) // {FANOUT}
  from upper_ where n > 1 group by level, pos // {FANOUT}, n),
depth as (select lang, max(level) as d from tree group by lang),
beside as (  -- siblings on either side of every node but the tops
  select a.lang, a.level, a.pos,
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), '') as l,
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos), '') as r
  from tree a join tree b on a.lang is not distinct from b.lang and a.level = b.level and a.pos // {FANOUT} = b.pos // {FANOUT}
  where a.n > 1 group by a.lang, a.level, a.pos
  union all
  select t.lang, p.d + u.level, -1,
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos < u.pos), ''),
         coalesce(string_agg(b.digest, '' order by b.pos) filter (where b.pos > u.pos), '')
  from tops t join depth p on p.lang is not distinct from t.lang
  join upper_ u on u.pos = t.pos // ({FANOUT} ** u.level)::bigint and u.n > 1
  join upper_ b on b.level = u.level and b.pos // {FANOUT} = u.pos // {FANOUT}
  group by t.lang, p.d, u.level, u.pos),
fold as (
  select lang, pos as leaf_pos, 0 as level, pos, seen as own, '' as proof from placed
  union all
  select f.lang, f.leaf_pos, f.level + 1, case when f.level + 1 < p.d then f.pos // {FANOUT} else -1 end,
         sha256(b.l || f.own || b.r), f.proof || b.l || b.r
  from fold f join depth p on p.lang is not distinct from f.lang
  join beside b on b.lang is not distinct from f.lang and b.level = f.level
       and b.pos = case when f.level < p.d then f.pos else -1 end),
done as (select lang, leaf_pos, arg_max(own, level) as own, arg_max(proof, level) as proof from fold group by lang, leaf_pos)
select p.doc_id, p.leaf, t.subroot, x.digest as root, sha256(o.proof) as proof_sha256, o.own as folded_root,
       o.own = x.digest as verified
from placed p join tops t on t.lang is not distinct from p.lang
join done o on o.lang is not distinct from p.lang and o.leaf_pos = p.pos
cross join (select digest from upper_ where n = 1) x
"""


ORACLE = {"op13_merkle_manifest": _sql()}
