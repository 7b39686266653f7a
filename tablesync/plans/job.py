"""One sync run: validate, read, compare, check, write, publish.

The plan is lazy up to the change set, which is written once to the shared folder.
Counts, constraint checks and the final write read that table, so nothing is joined
twice and counts stay exact when executors are lost. Nothing is visible before the
last step, so any error leaves rows, columns and watermark as they were.
"""

from __future__ import annotations

import logging
import time
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.coerce import coerce_to, require_ansi
from tablesync.operators.classify import IN_SOURCE, INSERT, KEEP, OP, PRUNE, UPDATE
from tablesync.operators.constraints import (
    any_null,
    null_key_rows,
    repeated_values,
    row_ranges,
    unique_violations,
    unique_violations_in_order,
)
from tablesync.operators.duplicates import count_writes, dedup, first_two, repeated_keys
from tablesync.operators.insert_only import accepted_rows
from tablesync.operators.keys import high_water_map
from tablesync.operators.merge import change_set, pruned_rows
from tablesync.operators.position import POSITION, with_position
from tablesync.operators.prune import prune_keep
from tablesync.operators.references import levels, orphan_rows
from tablesync.operators.schema import SchemaDiff, evolved, schema_diff
from tablesync.operators.watermark import (
    ReadSummary,
    Watermark,
    applicable,
    read_since,
    read_summary,
    summary_figures,
    summary_of,
)
from tablesync.plans.report import SyncReport, report_rows
from tablesync.session import Scratch
from tablesync.sources.readers import reads_alike
from tablesync.sources.relational import RelationalTarget
from tablesync.sources.snapshot import Pointer, SnapshotTarget, bucket_of
from tablesync.spec import SyncOptions, TableSpec, plain_name, safe_name

log = logging.getLogger(__name__)

SHOWN_KEYS = 20
NTH, TOP = "__nth", "__top"

Target = SnapshotTarget | RelationalTarget

# Steps of a run, told as each is done: changes are known, rows and columns are written but
# not visible, key maxima are known, the version is published.
COMPARED, STAGED, KEYS_KNOWN, PUBLISHED = "compared", "staged", "keys known", "published"
STEPS = (COMPARED, STAGED, KEYS_KNOWN, PUBLISHED)


class ConstraintError(Exception):
    """A source that breaks a constraint of the target; nothing was published."""

    def __init__(
        self, table: str, constraint: str, rows: Sequence[tuple], span: tuple[str, str] | None = None
    ) -> None:
        """``rows`` are keys of the first bad rows; ``span`` where bad source rows begin and end."""
        self.table, self.constraint, self.rows, self.span = table, constraint, list(rows), span
        where = f", source rows {span[0]} to {span[1]}" if span else ""
        super().__init__(f"{table}: {constraint} violated{where}, first rows {self.rows}")


def sync_table(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    target: Target,
    options: SyncOptions | None = None,
    parents: Mapping[str, Target] | None = None,
    on_step: Callable[[str], None] | None = None,
) -> SyncReport:
    """Make an existing target match a source by key.

    ``parents`` has the target of every table that the spec's references name. ``on_step``
    is told each of ``STEPS`` as it is done; an error it raises ends the run there.
    """
    pointer = target.pointer()
    if pointer is None:
        raise ValueError(f"target table does not exist: {spec.name}")
    spec, source = safe_names(spec, source, target)
    if set(pointer.key) != set(spec.key):
        raise ValueError(f"key of {spec.name} is {pointer.key}, not {spec.key}")
    run = Run(spark, spec, source, target, options or SyncOptions(), pointer)
    return replace(run, parents=parents or {}, on_step=on_step).execute()


def safe_names(spec: TableSpec, source: DataFrame, target: Target) -> tuple[TableSpec, DataFrame]:
    """Table and source under the names a stored target uses; a database quotes its own."""
    if isinstance(target, RelationalTarget):
        return spec, source
    return spec.safe(), source.toDF(*map(safe_name, source.columns))


def link_sync(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    target: SnapshotTarget,
    prune: bool = False,
    skip_dup: bool = False,
) -> DataFrame:
    """Sync a linked table on the columns both sides have; create a missing target.

    The key of ``spec`` only counts when the target is created; afterwards the key
    of the target does. One row: created, affected_rows, pruned_rows, sequences.
    """
    report = _link(spark, spec, source, target, prune, skip_dup)
    row = (report.created, report.affected_rows, report.deleted_rows, report.sequences)
    return spark.createDataFrame(
        [row],
        "created boolean, affected_rows long, pruned_rows long, sequences map<string,long>",
    )


def _link(spark, spec, source, target, prune, skip_dup) -> SyncReport:
    pointer = target.pointer()
    created = pointer is None
    if created:
        pointer = target.new_pointer(spec, source.schema)
    spec, source = safe_names(spec, source, target)
    spec = replace(
        spec, key=pointer.key, unique_keys=pointer.unique_keys, identity=pointer.identity
    )
    spec.check_source(source.schema)
    options = SyncOptions(
        prune=prune, allow_prune=True, insert_only=skip_dup, sync_sequence=True,
        # rows of a table that is all key have nothing to differ in: repeats are ignored
        on_duplicate="first" if set(pointer.schema.names) <= set(pointer.key) else "error",
    )
    shared = source.select(*[c for c in pointer.schema.names if c in source.columns])
    run = Run(spark, replace(spec, order_by=()), shared, target, options, pointer)
    return replace(run.execute(), created=created)


@dataclass
class Run:
    """State of one run of one table.

    ``partial`` says that ``source`` is not the whole source (a stream batch), which
    rules prune out. ``batch`` names a stream and its batch, published together with the
    rows. With
    ``take_late_rows`` the stored watermark stays a floor but filters nothing.
    """

    spark: SparkSession
    spec: TableSpec
    source: DataFrame
    target: Target
    options: SyncOptions
    pointer: Pointer
    partial: bool = False
    batch: tuple[str, int] | None = None
    take_late_rows: bool = False
    parents: Mapping[str, Target] = field(default_factory=dict)
    on_step: Callable[[str], None] | None = None

    def execute(self) -> SyncReport:
        report = self._execute()
        return replace(
            report,
            identity=tuple(map(plain_name, report.identity)),
            target_only=tuple(map(plain_name, report.target_only)),
            retyped=tuple(map(plain_name, report.retyped)),
            added_columns={plain_name(c): kind for c, kind in report.added_columns.items()},
            sequences={plain_name(c): top for c, top in report.sequences.items()},
        )

    def _execute(self) -> SyncReport:
        self._validate()
        diff = schema_diff(self.source.schema, self.pointer.schema, self.spec.declared_types)
        report = self._described(diff)
        if self.options.dry_run:
            return replace(report, dry_run=True)
        if diff.missing and not self.options.add_columns:
            raise ValueError(
                f"{self.spec.name}: columns missing in the target: {[f.name for f in diff.missing]}"
            )
        if diff.target_only:
            log.warning("%s: only in the target, kept: %s", self.spec.name, diff.target_only)
        if diff.retyped:
            log.warning("%s: types differ, not changed: %s", self.spec.name, diff.retyped)
        scratch = Scratch(self.spark)
        try:
            return self._sync(report, evolved(self.pointer.schema, diff), scratch)
        finally:
            scratch.clear()

    # -- steps -------------------------------------------------------------------

    def _validate(self) -> None:
        self.options.check_prune()
        if self.partial and self.options.prune:
            raise ValueError("prune needs the whole source")
        self.spec.check_source(self.source.schema)
        column = self.options.incremental_col
        if column and column not in self.source.columns:
            raise ValueError(f"incremental column not in {self.spec.name}: {column}")
        kinds = {f.name: f.dataType for f in self.pointer.schema.fields}
        if any(kinds.get(f.name, f.dataType) != f.dataType for f in self.source.schema.fields):
            require_ansi(self.spark)

    def _described(self, diff: SchemaDiff) -> SyncReport:
        return SyncReport(
            table=self.spec.name,
            mode="incremental" if self.options.incremental_col else "full",
            identity=self.pointer.identity,
            added_columns=diff.added() if self.options.add_columns else {},
            target_only=diff.target_only,
            retyped=tuple(f"{name}: {old} -> {new}" for name, old, new in diff.retyped),
            unique_check=self.options.unique_check,
            version=self.pointer.version if self.pointer.version else None,
        )

    def _sync(self, report: SyncReport, schema: T.StructType, scratch: Scratch) -> SyncReport:
        options, key = self.options, self.pointer.key
        column = options.incremental_col
        bound = applicable(self.pointer.watermark, column, options.full_refresh) if column else None
        part = with_position(self.source)
        if column and not self.take_late_rows:
            part = read_since(part, column, bound)
        if bound is not None or self.partial or not reads_alike(part):
            # checks and merge see the same rows, in the order they were read
            part = with_position(scratch.write(part, "increment"))
            if bound is None and not self.partial:
                self.source = part
        rows = _placed(part, schema)
        loaded = bool(self.pointer.live or self.pointer.deltas)
        whole = bound is None and not self.partial
        passed = None
        if loaded and whole and not options.insert_only:
            passed = self._in_one_pass(part, rows, schema, scratch)
        order = self._order(rows)
        repeated, single = None, rows
        if passed is None and not (loaded or options.insert_only):
            passed = self._first_load(part, rows, schema, scratch)
        if passed is None:
            read = read_summary(part, key, column, bound)
            if read.null_keys:
                self._refuse_null_keys(rows)
            repeated = self._repeated_keys(rows, scratch)
            if repeated is not None and not options.insert_only:
                single = self._single(rows, repeated, order)
            if not (loaded or options.insert_only):
                changes = None
                staged = self._stage_first(single, schema)
                counts = {INSERT: self.target.rows(staged).count()}
            else:
                changes = scratch.write(
                    self._changes(rows, single, schema, scratch, bound), "changes"
                )
                counts = dict(changes.groupBy(OP).count().collect())
        else:
            read, changes, counts, staged = passed
        if changes is not None:
            self._check_unique(changes, single, schema)
            given = [c for c in rows.columns if c != POSITION]
            self._done(COMPARED)
            staged = self.target.stage(self.pointer, schema, changes, counts, given)
        self._check_references(single if changes is None else changes, staged)
        self._done(STAGED)

        affected = counts.get(INSERT, 0) + counts.get(UPDATE, 0)
        if repeated is not None and not options.insert_only and options.on_duplicate == "last":
            affected = self._writes(rows, repeated, schema, scratch, order, affected)
        staged = replace(staged, high_water=None if affected else self.pointer.high_water)
        sequences: dict[str, int] = {}
        if options.sync_sequence and self.pointer.identity:
            sequences = self._high_water(staged, counts, changes)
            staged = replace(staged, high_water=sequences)
        self._done(KEYS_KNOWN)
        version = self._publish(staged, read.watermark)
        self._done(PUBLISHED)
        return replace(
            report,
            read_rows=read.rows,
            affected_rows=affected,
            deleted_rows=counts.get(PRUNE, 0),
            sequences=sequences,
            sequence_synced=bool(sequences),
            watermark=read.watermark.value if read.watermark else None,
            version=version,
        )

    def _single(self, rows: DataFrame, repeated: DataFrame, order: list[str]) -> DataFrame:
        """One row per key; only keys that repeat go through de-duplication."""
        key = list(self.pointer.key)
        keep = "first" if self.options.on_duplicate == "first" else "last"
        several = rows.join(repeated.select(*key), key, "left_semi")
        others = rows.join(repeated.select(*key), key, "left_anti")
        return others.unionByName(dedup(several, key, order, keep)).select(*rows.columns)

    def _in_one_pass(
        self, part: DataFrame, rows: DataFrame, schema: T.StructType, scratch: Scratch
    ) -> tuple[ReadSummary, DataFrame, dict[str, int], None] | None:
        """Compare the whole source and learn what it holds while changes are written.

        Figures are observed behind the join, in the tasks that write, so tasks that run
        again do not count twice. None when keys repeat: what was written is then dropped
        with the run's other tables, and rows are de-duplicated first.
        """
        key, column, prune = self.pointer.key, self.options.incremental_col, self.options.prune
        kind = part.schema[column].dataType if column else None
        watched, carried = rows, []
        if column:
            watched, carried = _placed(part, schema, F.col(column).alias(TOP)), [TOP]
        unique = self.options.source_key_is_unique
        if not unique:
            watched, carried = first_two(watched, key, NTH), [*carried, NTH]
        figures = summary_figures(key, TOP if column else None, kind, None, F.col(IN_SOURCE))
        figures += [F.count_if(F.col(OP) == op).alias(op) for op in (INSERT, UPDATE, KEEP)]
        figures += [] if unique else [F.max(NTH).alias("most")]
        seen = Observation()
        current = self.target.rows(replace(self.pointer, schema=schema))
        changes = change_set(
            watched, current, key, prune, None, lambda df: df.observe(seen, *figures), carried
        )
        changes = scratch.write(changes, "changes")
        found = _figures(seen)
        read = summary_of(found, column, kind)
        if read.null_keys:
            self._refuse_null_keys(rows)
        if (found["most"] or 0) > 1:
            return None
        counts = {op: found[op] for op in (INSERT, UPDATE)}
        counts[PRUNE] = found[KEEP] if prune else 0
        return read, changes, {op: n for op, n in counts.items() if n}, None

    def _first_load(
        self, part: DataFrame, rows: DataFrame, schema: T.StructType, scratch: Scratch
    ) -> tuple[ReadSummary, None, dict[str, int], Pointer] | None:
        """Fill an empty table, or None when keys repeat."""
        key, column = self.pointer.key, self.options.incremental_col
        if self._repeated_keys(rows, scratch) is not None:
            return None
        kind = part.schema[column].dataType if column else None
        watched = _placed(part, schema, F.col(column).alias(TOP)) if column else rows
        seen = Observation()
        watched = watched.observe(seen, *summary_figures(key, TOP if column else None, kind, None))
        staged = self._stage_first(watched, schema)
        read = summary_of(_figures(seen), column, kind)
        if read.null_keys:
            self._refuse_null_keys(rows)
        n = self.target.rows(staged).count()  # exact whatever ran twice
        return replace(read, rows=n), None, {INSERT: n}, staged

    def _stage_first(self, single: DataFrame, schema: T.StructType) -> Pointer:
        self._check_first_load(single)
        return self.target.stage_first(self.pointer, schema, _complete(single, schema))

    def _high_water(
        self, staged: Pointer, counts: dict[str, int], changes: DataFrame | None
    ) -> dict[str, int]:
        """Key maxima: the stored ones raised by the new rows, or a scan where rows went."""
        known, columns = self.pointer.high_water, self.pointer.identity
        if known is None or changes is None or counts.get(PRUNE):
            return high_water_map(self.target.rows(staged), columns)
        if not counts.get(INSERT):
            return known
        new = high_water_map(changes.where(F.col(OP) == INSERT), columns)
        return {c: max(known[c], new[c]) for c in columns}

    def _order(self, rows: DataFrame) -> list[str]:
        """The declared order, else the incremental column; then the order of reading."""
        names = [*self.spec.order_by]
        if not names and self.options.incremental_col in rows.columns:
            names = [self.options.incremental_col]
        if POSITION in names and POSITION not in rows.columns:
            raise ValueError(f"rows of {self.spec.name} have no place in files to order them by")
        if POSITION in rows.columns and POSITION not in names:
            names.append(POSITION)
        return names

    def _refuse_null_keys(self, rows: DataFrame) -> None:
        key = self.pointer.key
        shown = null_key_rows(rows, key).select(*key).limit(SHOWN_KEYS).collect()
        raise ConstraintError(self.spec.name, "key not null", [tuple(r) for r in shown])

    def _repeated_keys(self, rows: DataFrame, scratch: Scratch) -> DataFrame | None:
        """Keys that several source rows have, or None."""
        key = self.pointer.key
        if self.options.source_key_is_unique:
            return None
        repeated = repeated_keys(rows, key, scratch)
        if repeated is None:
            return None
        if self.options.on_duplicate == "error" and not self.options.insert_only:
            shown = repeated.select(*key).limit(SHOWN_KEYS).collect()
            raise ConstraintError(self.spec.name, "one row per key", [tuple(r) for r in shown])
        return repeated

    def _whole_keys(self, schema: T.StructType) -> DataFrame:
        key = [f for f in schema.fields if f.name in self.pointer.key]
        return coerce_to(self.source, T.StructType(key))

    def _changes(
        self,
        rows: DataFrame,
        single: DataFrame,
        schema: T.StructType,
        scratch: Scratch,
        bound: Watermark | None,
    ) -> DataFrame:
        key, prune = self.pointer.key, self.options.prune
        whole = bound is None and not self.partial
        # A part of the source only meets the buckets of its keys; prune and unique
        # keys look at the whole target.
        by_key = not (prune or (self.options.insert_only and self.pointer.unique_keys))
        buckets = self._touched(single) if by_key and not whole else None
        current = self.target.rows(replace(self.pointer, schema=schema), buckets)
        if self.options.insert_only:
            known = self._whole_keys(schema) if prune else None
            stays = prune_keep(current, known, key) if prune else current
            given = [u for u in self.pointer.unique_keys if set(u) <= set(rows.columns)]
            accepted = accepted_rows(
                rows, stays, key, scratch, given, self._order(rows), narrow=not whole
            )
            new = _complete(accepted, schema).select(F.lit(INSERT).alias(OP), *schema.names)
            return new.unionByName(pruned_rows(current, known, key)) if prune else new
        if whole:
            return change_set(single, current, key, prune)
        known = self._whole_keys(schema) if prune else single
        return change_set(single, current, key, prune, known)

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that hold these keys: at most one small row per bucket."""
        return sorted(r["bucket"] for r in rows.select(self._bucket()).distinct().collect())

    def _bucket(self) -> Column:
        return bucket_of(self.pointer.key, self.pointer.buckets).alias("bucket")

    def _check_first_load(self, rows: DataFrame) -> None:
        for unique in self.pointer.unique_keys:
            if not set(unique) <= set(rows.columns):
                continue  # NULL in every new row
            bad = repeated_values(rows, unique).select(*unique)
            shown = bad.limit(SHOWN_KEYS).collect()
            if shown:
                span = self._span(rows, bad, unique)
                rows_shown = [tuple(r) for r in shown]
                raise ConstraintError(self.spec.name, f"unique {unique}", rows_shown, span)

    def _check_unique(self, changes: DataFrame, single: DataFrame, schema: T.StructType) -> None:
        if self.options.insert_only:
            return
        key = self.pointer.key
        before = self.target.rows(replace(self.pointer, schema=schema))
        stays = prune_keep(before, self._whole_keys(schema), key) if self.options.prune else before
        for unique in self.pointer.unique_keys:
            if not set(unique) <= set(single.columns):
                continue
            # a database checks while it applies row by row
            strict = self.options.unique_check == "strict" or isinstance(self.target, RelationalTarget)
            if strict:
                bad = unique_violations_in_order(
                    single, stays, key, unique, self._order(single)
                )
            else:
                bad = unique_violations(before, changes, key, unique)
            shown = bad.select(*key).limit(SHOWN_KEYS).collect()
            if shown:
                raise ConstraintError(
                    self.spec.name,
                    f"unique {unique}",
                    [tuple(r) for r in shown],
                    self._span(single, bad, unique),
                )

    def _span(
        self, rows: DataFrame, bad: DataFrame, unique: Sequence[str]
    ) -> tuple[str, str] | None:
        """Where the source rows of a violation begin and end, if rows have a place."""
        if POSITION not in rows.columns:
            return None
        ranges = row_ranges(rows, bad, unique)
        first, last = ranges.agg(F.min("first_row"), F.max("last_row")).first()
        if first is None:
            return None
        return tuple(f"{place['file']}#{place['row']}".lstrip("#") for place in (first, last))

    def _done(self, step: str) -> None:
        if self.on_step:
            self.on_step(step)

    def _check_references(self, written: DataFrame, staged: Pointer) -> None:
        """Rows about to be published name parents that are published, or in their own table."""
        if OP in written.columns:
            written = written.where(F.col(OP).isin(INSERT, UPDATE))
        for reference in self.spec.references:
            if not set(reference.columns) <= set(written.columns):
                continue
            if reference.parent == self.spec.name:
                parent = self.target.rows(staged)
            elif reference.parent in self.parents:
                parent = self.parents[reference.parent].rows()
            else:
                raise ValueError(f"{self.spec.name}: no target is given for parent {reference.parent}")
            bad = orphan_rows(written, parent, reference.columns, reference.parent_columns)
            shown = bad.select(*self.pointer.key).limit(SHOWN_KEYS).collect()
            if shown:
                raise ConstraintError(
                    self.spec.name,
                    f"reference {reference.columns} to {reference.parent}",
                    [tuple(r) for r in shown],
                )

    def _writes(self, rows, repeated, schema, scratch, order, affected) -> int:
        """Affected rows when repeated keys are applied row by row."""
        key = list(self.pointer.key)
        before = self.target.rows(replace(self.pointer, schema=schema))
        several = rows.join(repeated.select(*key), key, "left_semi")
        known = before.join(repeated.select(*key), key, "left_semi")
        by_row = count_writes(several, known, key, order, scratch).first()["writes"]
        last = dedup(several, key, order)
        final = change_set(last, known, key).count()
        return affected - final + by_row

    def _publish(self, staged: Pointer, watermark: Watermark | None) -> int:
        """One rename makes rows, columns, watermark and batch visible together."""
        staged = replace(
            staged,
            watermark=watermark or self.pointer.watermark,
            batches=self.pointer.batches | dict([self.batch] if self.batch else []),
        )
        if replace(staged, version=self.pointer.version) == self.pointer and self.target.exists():
            return self.pointer.version  # nothing to write, nothing to publish
        self.target.commit(staged)
        return staged.version


def _figures(seen: Observation) -> defaultdict[str, object]:
    """What was observed; maxima that were not asked for are None.

    Over a plan that Spark knows to be empty it does not observe: then all is zero or None.
    """
    found: defaultdict[str, object] = defaultdict(lambda: None)
    try:
        found.update(seen.get)
    except Py4JJavaError:
        found.update({name: 0 for name in ("n", "nulls", INSERT, UPDATE, KEEP)})
    return found


def _placed(part: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """Coerced rows that keep their place in the source, where they have one."""
    place = [part.schema[POSITION]] if POSITION in part.columns else []
    return coerce_to(part, T.StructType([*schema.fields, *place]), *more)


def _complete(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """All target columns; those the source lacks are NULL."""
    present = set(rows.columns)
    return rows.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


@dataclass(frozen=True)
class TableJob:
    """A table of a multi-table run. ``open_source`` runs inside the job's own try."""

    spec: TableSpec
    open_source: Callable[[], DataFrame]
    target: Target
    options: SyncOptions = SyncOptions()


@dataclass(frozen=True)
class RunResult:
    reports: tuple[SyncReport, ...]

    @property
    def exit_code(self) -> int:
        """0 when every table is in sync, 1 when some failed."""
        return 1 if any(r.error for r in self.reports) else 0


def run_all(
    spark: SparkSession,
    jobs: Sequence[TableJob],
    parallel: int = 1,
    parents: Mapping[str, Target] | None = None,
) -> RunResult:
    """Sync tables, parents before children; one table's failure does not stop the others.

    Tables go in levels by their references, in the order given inside a level. A child is
    checked against what its parents have published by then, whether they succeeded or not;
    ``parents`` has the targets of parents that are not part of the run. Refused prune stops
    the run before any table. ``parallel`` above one lets the tables of a level share the
    cluster (set ``spark.scheduler.mode=FAIR``). Reports keep the order given.
    """
    for job in jobs:
        job.options.check_prune()
    targets = {**(parents or {}), **{job.spec.name: job.target for job in jobs}}
    named: dict[str, list[str]] = {}
    for job in jobs:
        named.setdefault(job.spec.name, []).extend(r.parent for r in job.spec.references)

    def one(job: TableJob) -> SyncReport:
        try:
            return sync_table(spark, job.spec, job.open_source(), job.target, job.options, targets)
        except Exception as error:  # a table's failure is a row of the report
            log.error("%s failed: %s", job.spec.name, error)
            mode = "incremental" if job.options.incremental_col else "full"
            return SyncReport(table=job.spec.name, mode=mode, error=str(error))

    reports: dict[int, SyncReport] = {}
    for level in levels(named):
        mine = [i for i, job in enumerate(jobs) if job.spec.name in level]
        if parallel <= 1:
            reports |= {i: one(jobs[i]) for i in mine}
        else:
            with ThreadPoolExecutor(parallel) as pool:
                reports |= dict(zip(mine, pool.map(one, [jobs[i] for i in mine])))
    return RunResult(tuple(reports[i] for i in range(len(jobs))))


def retried(run: Callable[[], SyncReport], attempts: int, wait: float = 0) -> SyncReport:
    """Start a run again when it fails: a failed run published all of its version or none.

    A broken constraint, a refused option or a source that does not fit would fail again and
    is raised at once. ``run`` is called anew each time, so it sees what was published.
    """
    for left in range(attempts - 1, -1, -1):
        try:
            return run()
        except (ConstraintError, ValueError, TypeError, PermissionError):
            raise
        except Exception as error:
            if not left:
                raise
            log.warning("run failed, %d attempts left: %s", left, error)
            time.sleep(wait)
    raise ValueError("attempts must be at least 1")


def run_report(spark: SparkSession, result: RunResult) -> DataFrame:
    return report_rows(spark, result.reports)
