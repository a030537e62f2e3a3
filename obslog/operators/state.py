"""State maintenance without a table format: old state in, new state and change rows out.

The caller writes both as a new version; `changes` rows have the columns of the state and
_change_type, _commit_version and _commit_timestamp."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.operators.contracts import copies, refused, repeated
from obslog.schemas import EntitySpec

INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_preimage", "update_postimage"


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, t and s: the two rows of each key as structs, of which one may be null."""
    t = target.select(*keys, F.struct(*target.columns).alias("t"))
    s = source.select(*keys, *[c for c in ("_copies",) if c in source.columns], F.struct(*target.columns).alias("s"))
    return t.join(s, list(keys), "full_outer")


def _images(sides: DataFrame, columns: Sequence[str], version: int, committed_at: Column) -> DataFrame:
    """Change rows of sides with an `act`: insert, update or delete; others give none."""
    image = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))
    rows = F.when(F.col("act") == "insert", F.array(image(INSERT, F.col("s")))).when(F.col("act") == "delete", F.array(image(DELETE, F.col("t")))).when(
        F.col("act") == "update", F.array(image(BEFORE, F.col("t")), image(AFTER, F.col("s")))
    )
    out = sides.select(F.explode(rows).alias("x")).select("x.row.*", "x._change_type")
    return out.withColumn("_commit_version", F.lit(version).cast("long")).withColumn("_commit_timestamp", committed_at.cast("timestamp"))


Keep = Callable[[DataFrame], DataFrame]


def guarded_upsert(target: DataFrame, source: DataFrame, spec: EntitySpec, version: int = 0, committed_at: Column | None = None, keep: Keep | None = None, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new state, changes): a source row replaces its target row unless it is older, or is added.

    An equal order value replaces too, and then leaves a pair of images even if nothing
    differs. A source that has a key twice fails the plan, before anything of it is committed;
    a caller that knows better may turn the check off. Both results
    come from the same full outer join on the key; `keep` (such as `sources.folder.cut`)
    holds it where both are used, else each computes it."""
    sides = _sides(target, source.withColumn("_copies", copies(spec.keys)) if check else source, spec.keys)
    if check:  # the count is by the join's key, so that both share one exchange
        sides = refused(sides, F.col("_copies") > 1, repeated(spec.keys, spec.name))
    newer = F.col(f"s.{spec.order}") >= F.col(f"t.{spec.order}")
    act = F.when(F.col("t").isNull(), "insert").when(F.col("s").isNotNull() & newer, "update").otherwise("keep")
    sides = sides.withColumn("act", act)
    sides = keep(sides) if keep else sides
    state = sides.select(F.when(F.col("act") == "keep", F.col("t")).otherwise(F.col("s")).alias("row")).select("row.*")
    return state, _images(sides, target.columns, version, committed_at if committed_at is not None else F.lit(None))


def orphan_relations(relations: DataFrame, scope: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Relations outside the observed scope, or of another time or run than their parent's observation."""
    parents = scope.select(*keys, F.col("observed_at").alias("_at"), F.col("source_run_id").alias("_run"))
    joined = relations.join(parents, list(keys), "left")
    inside = F.col("_at").eqNullSafe(F.col("observed_at")) & F.col("_run").eqNullSafe(F.col("source_run_id")) & F.col("_at").isNotNull()
    return joined.where(~inside).drop("_at", "_run")


def stale_relations(target: DataFrame, scope: DataFrame, relations: DataFrame, parent_keys: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Stored relations of observed parents that the observation, if not older, no longer has."""
    seen = scope.select(*parent_keys, F.col("observed_at").alias("_seen"))
    inside = target.join(seen, list(parent_keys)).where(F.col("observed_at") <= F.col("_seen")).drop("_seen")
    return inside.join(relations.select(*keys), list(keys), "left_anti")


def reconcile(
    target: DataFrame, scope: DataFrame, relations: DataFrame, parent_keys: Sequence[str], spec: EntitySpec, version: int = 0, committed_at: Column | None = None,
    parent_state: DataFrame | None = None, keep: Keep | None = None, check: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(new state, changes) of a child set: what each observed parent has now replaces what it had.

    Newer or equally old relations are updated, new ones added, and stored ones of an
    observed parent that it no longer has removed, if they are not newer than the
    observation. A parent without relations loses all. Without `parent_state` an old
    observation can bring back a relation that was removed since; with it (the parents'
    current rows with updated_at) observations older than the parent's state are left out.

    A relation outside the scope, or of another time or run than its parent's observation,
    and a parent or relation that comes twice, fail the plan unless `check` is off."""
    seen = scope.select(*parent_keys, F.col("observed_at").alias("_seen"), F.col("source_run_id").alias("_run"))
    if check:  # a parent without relations of its own meets no row of the join, so it fails where it stands
        seen = refused(seen.withColumn("_copies", copies(parent_keys)), F.col("_copies") > 1, repeated(parent_keys, "scope")).drop("_copies")
        relations = relations.withColumn("_copies", copies(spec.keys))
    if parent_state is not None:
        now = parent_state.select(*parent_keys, F.col("updated_at").alias("_now"))
        seen = seen.join(now, list(parent_keys), "left").withColumn("_stale", F.coalesce(F.col("_seen") < F.col("_now"), F.lit(False))).drop("_now")
    sides = _sides(target, relations, spec.keys).join(seen, list(parent_keys), "left")
    if check:
        inside = F.col("_seen").isNotNull() & F.col("_seen").eqNullSafe(F.col("s.observed_at")) & F.col("_run").eqNullSafe(F.col("s.source_run_id"))
        outside = F.col("s").isNotNull() & ~inside
        told = F.when(outside, F.lit(f"{spec.name}: a relation is outside the observed scope")).otherwise(repeated(spec.keys, spec.name))
        sides = refused(sides, outside | (F.col("_copies") > 1), told)
    newer = F.col("s.observed_at") >= F.col("t.observed_at")
    act = (
        F.when(F.col("t").isNull(), "insert")
        .when(F.col("s").isNotNull(), F.when(newer, "update").otherwise("keep"))
        .when(F.col("t.observed_at") <= F.col("_seen"), "delete")
        .otherwise("keep")
    )
    if parent_state is not None:
        act = F.when(F.coalesce("_stale", F.lit(False)), F.when(F.col("t").isNull(), "skip").otherwise("keep")).otherwise(act)
    sides = sides.withColumn("act", act)
    sides = keep(sides) if keep else sides
    state = sides.where("act NOT IN ('delete', 'skip')").select(F.when(F.col("act") == "keep", F.col("t")).otherwise(F.col("s")).alias("row")).select("row.*")
    return state, _images(sides, target.columns, version, committed_at if committed_at is not None else F.lit(None))


def _committed_at(committed: dict[int, str]) -> Column:
    """The time of each version: one literal a version that is folded."""
    return F.create_map(*[x for v, at in sorted(committed.items()) for x in (F.lit(v), F.lit(at).cast("timestamp"))])[F.col("_commit_version").cast("int")]


class Folded(NamedTuple):
    """What a fold gives: the state after all versions, the changes of all versions, and what the state was at each of them."""

    state: DataFrame
    changes: DataFrame
    at: Callable[[int], DataFrame]


def fold_upserts(rows: DataFrame, spec: EntitySpec, committed: dict[int, str], keep: Keep | None = None, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(state after all versions, changes of all versions): what `guarded_upsert` gives, version after version, from an empty state.

    rows: the columns of the state, with a value in the order column, and _version, of which
    `committed` has the time. A version's guard asks for the newest row so far, which is a
    running maximum by key: all versions share one exchange and one sort, in place of an outer
    join and a written state for each; rows that lie in buckets of the keys need no exchange. A key that comes twice in a version fails the plan
    unless `check` is off."""
    return folded_upserts(rows, spec, committed, keep, check)[:2]


def folded_upserts(rows: DataFrame, spec: EntitySpec, committed: dict[int, str], keep: Keep | None = None, check: bool = True) -> Folded:
    """`fold_upserts`, and the state at each version."""
    columns = [c for c in rows.columns if c != "_version"]
    rest = [c for c in columns if c not in spec.keys]
    placed = rows.select(*spec.keys, "_version", F.struct(F.col(spec.order).alias("o"), F.col("_version").alias("v"), F.struct(*rest).alias("row")).alias("s"))
    in_order = Window.partitionBy(*spec.keys).orderBy("_version")
    so_far = F.max("s").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    folded = placed.withColumn("t", so_far).withColumn("_until", F.lead("_version").over(in_order))
    if check:  # rows of a key are in order, so that a version that comes twice stands next to itself
        folded = refused(folded.withColumn("_again", F.lag(F.struct("_version")).over(in_order).eqNullSafe(F.struct("_version"))), F.col("_again"), repeated(spec.keys, spec.name), spec.keys if keep else ())
    folded = folded.select(*spec.keys, "s", "t", "_until")
    folded = keep(folded) if keep else folded
    act = F.when(F.col("t").isNull(), "insert").when(F.col("s.o") >= F.col("t.o"), "update").otherwise("keep")
    sides = folded.select(*spec.keys, F.col("t.row").alias("t"), F.col("s.row").alias("s"), act.alias("act"), F.col("s.v").alias("_commit_version"))

    def newest(of: DataFrame) -> DataFrame:
        return of.select(*spec.keys, F.greatest("s", "t").alias("s")).select(*[F.col(c) if c in spec.keys else F.col(f"s.row.{c}") for c in columns])

    def at(version: int) -> DataFrame:
        return newest(folded.where((F.col("s.v") <= version) & (F.col("_until").isNull() | (F.col("_until") > version))))

    return Folded(newest(folded.where("_until IS NULL")), _fold_images(sides, columns, committed), at)


def _fold_images(sides: DataFrame, columns: Sequence[str], committed: dict[int, str]) -> DataFrame:
    """Change rows of sides whose keys are columns of their own, before the images t and s of the others."""
    image = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))
    rows = F.when(F.col("act") == "insert", F.array(image(INSERT, F.col("s")))).when(F.col("act") == "delete", F.array(image(DELETE, F.col("t")))).when(
        F.col("act") == "update", F.array(image(BEFORE, F.col("t")), image(AFTER, F.col("s")))
    )
    keys = [c for c in sides.columns if c in columns]
    out = sides.select(*keys, F.col("_commit_version").cast("long").alias("_commit_version"), F.explode(rows).alias("x"))
    return out.select(*[F.col(c) if c in keys else F.col(f"x.row.{c}") for c in columns], "x._change_type", "_commit_version", _committed_at(committed).alias("_commit_timestamp"))


def fold_reconciles(scopes: DataFrame, children: str, child: str, committed: dict[int, str], parent_keys: Sequence[str], keep: Keep | None = None) -> tuple[DataFrame, DataFrame]:
    """(state after all versions, changes of all versions): what `reconcile` gives, version after version, from an empty state.

    scopes: the parents' observations (parent_keys, observed_at, source_run_id, `children`: a list of the
    keys that each has, and _version), one for a parent and version. A child's history
    is the list of its parent's observations, each with or without it, and is folded in its
    row: one exchange by parent, or none if the scopes lie in buckets of the parents, and no state is written between versions. What must fit a
    task is a parent's observations in the versions that are folded."""
    return folded_reconciles(scopes, children, child, committed, parent_keys, keep)[:2]


def folded_reconciles(scopes: DataFrame, children: str, child: str, committed: dict[int, str], parent_keys: Sequence[str], keep: Keep | None = None) -> Folded:
    """`fold_reconciles`, and the state at each version."""
    keys, columns = [*parent_keys, child], [*parent_keys, child, "observed_at", "source_run_id"]
    seen = F.struct(F.col("_version").alias("v"), "observed_at", "source_run_id", F.col(children).alias("has"))
    grouped = scopes.groupBy(*parent_keys).agg(F.sort_array(F.collect_list(seen)).alias("seen"))
    every = F.array_distinct(F.flatten(F.transform("seen", lambda o: o["has"])))
    one = grouped.select(*parent_keys, "seen", F.explode(every).alias(child))
    row = F.struct(F.element_at("seen", 1)["observed_at"].alias("observed_at"), F.element_at("seen", 1)["source_run_id"].alias("source_run_id"))
    maybe = F.when(F.col(child).isNull(), row)  # a row or none: the type of what may be null
    step = F.struct(maybe.alias("t"), maybe.alias("s"), F.lit("").alias("act"), F.lit(0).cast("long").alias("_commit_version"))
    nothing = F.struct(F.when(F.lit(False), maybe).alias("t"), F.filter(F.array(step), lambda x: F.lit(False)).alias("out"))

    def then(acc: Column, o: Column) -> Column:
        t, has = acc["t"], F.array_contains(o["has"], F.col(child))
        s = F.struct(o["observed_at"].alias("observed_at"), o["source_run_id"].alias("source_run_id"))
        act = (
            F.when(t.isNull(), F.when(has, "insert").otherwise("none"))
            .when(has, F.when(o["observed_at"] >= t["observed_at"], "update").otherwise("none"))
            .when(t["observed_at"] <= o["observed_at"], "delete")
            .otherwise("none")
        )
        now = F.when(act.isin("insert", "update"), s).when(act == "delete", F.lit(None)).otherwise(t)
        change = F.struct(t.alias("t"), s.alias("s"), act.alias("act"), o["v"].cast("long").alias("_commit_version"))
        return F.struct(now.alias("t"), F.when(act == "none", acc["out"]).otherwise(F.array_append(acc["out"], change)).alias("out"))

    folded = one.select(*keys, F.aggregate("seen", nothing, then).alias("f")).select(*keys, "f.t", "f.out")
    folded = keep(folded) if keep else folded

    def at(version: int) -> DataFrame:
        """A child's last change so far says whether it is there: all but a deletion leave their image."""
        last = F.try_element_at(F.filter("out", lambda x: x["_commit_version"] <= version), F.lit(-1))
        return folded.select(*keys, last.alias("x")).where("x.act <> 'delete'").select(*keys, "x.s.*")

    return Folded(folded.where("t IS NOT NULL").select(*keys, "t.*"), _fold_images(folded.select(*keys, F.inline("out")), columns, committed), at)


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows and the source rows of new keys: the first write wins."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti"))


def conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows of a known key with other content, compared as whole rows with nulls equal."""
    rest = [c for c in target.columns if c not in keys]
    known = target.select(*keys, F.struct(*rest).alias("_known"))
    return source.join(known, list(keys)).where(~F.struct(*rest).eqNullSafe(F.col("_known"))).drop("_known")


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with those of the source's keys replaced, whatever their age (incremental model, merge)."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").unionByName(source)


def replace_workset(target: DataFrame, workset: DataFrame, rebuilt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without those of the workset's keys, and the rebuilt rows (incremental model, delete and append)."""
    return target.join(workset.select(*keys).distinct(), list(keys), "left_anti").unionByName(rebuilt)
