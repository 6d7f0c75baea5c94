"""Resolve a named feature over a time range: read what is stored, compute and store the rest.

The absent slots of a feature are computed by one plan with the slot as a grouping column, also those of tables that carry
state from slot to slot. The manifest keeps what each slot was made from, so slots whose input came late can be found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.operators.tables import concat_common, trim_columns
from flowloom.plans.registry import ERROR, PARTIAL, SKIP, Feature, Input, MissingInput, Registry
from flowloom.plans.slots import MONTH, YEAR, Slot, Timescale, epoch, floor_to, is_slot, moment_lit, stamp, tile
from flowloom.plans.store import SlotStore
from flowloom.session import configure
from flowloom.sources.files import existing


@dataclass
class Settings:
    """Site-specific values the recipes read."""

    home_site: str = "home"
    zone: str = "America/New_York"
    expiry_days: int = 30
    match_band: float = 300.0
    # What a history without any stored day before it starts from: "empty", or None to refuse.
    seed: str | None = None
    # Lookup tables by name: a DataFrame, or a function of the session that gives one.
    tables: dict[str, DataFrame | Callable[[SparkSession], DataFrame]] = field(default_factory=dict)


@dataclass
class Context:
    spark: SparkSession
    settings: Settings
    slots: list[Slot]

    def table(self, name: str) -> DataFrame:
        found = self.settings.tables.get(name)
        if found is None:
            raise KeyError(f"the recipe needs the table {name!r} in the settings")
        return found(self.spark) if callable(found) else found


@dataclass
class Found:
    """Rows of some slots; which slots have a result, what the others lack, and what each one is made of: itself if it is
    raw or stored, else the slots it was computed from."""

    frame: DataFrame | None
    done: set[Slot]
    lacking: dict[Slot, frozenset[str]]
    skipped: set[Slot]
    made_of: dict[Slot, frozenset[str]] = field(default_factory=dict)


@dataclass
class State:
    """What a slot counts as for those made from it, whether it is late, when it was written, and whether it is stored."""

    made: frozenset[str]
    late: bool = False
    written: float = 0.0
    stored: bool = False


def _leaf(feature: Feature, slot: Slot) -> frozenset[str]:
    return frozenset({f"{feature.name}@{stamp(slot[0])}"})


class Resolver:
    def __init__(
        self, spark: SparkSession, registry: Registry, root: str, raw_root: str | None = None,
        settings: Settings | None = None,
    ):
        self.spark = configure(spark)
        self.registry = registry
        self.root = root.rstrip("/")
        self.raw_root = (raw_root or root).rstrip("/")
        self.settings = settings or Settings()
        self.store = SlotStore(spark, store_root(self.root))
        self._schemas: dict[str, T.StructType] = {}

    # -- public ------------------------------------------------------------------------------------

    def get(
        self, name: str, start: datetime, end: datetime, columns: Sequence[str] | None = None,
        save_dir: str | None = None, allow_missing: bool = False, keep_slot: bool = False,
    ) -> DataFrame:
        """Rows of a feature over a range.

        Slots that cannot be computed are an error, unless ``allow_missing`` and some slot can.
        ``save_dir`` stores the result there, whether or not the feature is kept by default.
        """
        feature = self.registry[name]
        if start >= end:
            raise ValueError("the start must lie before the end")
        slots = tile(start, end, feature.timescale)
        found = self._slots(feature, slots, columns, save_dir)
        if found.lacking and (not allow_missing or not found.done):
            raise MissingInput(name, frozenset().union(*found.lacking.values()))
        frame = found.frame if found.frame is not None else self._empty(feature, columns)
        return frame if keep_slot else frame.drop("slot_start")

    def load_available(
        self, name: str, start: datetime, end: datetime, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """What is stored in the range; nothing is computed."""
        return self.load_available_slots(name, start, end, columns).drop("slot_start")

    def load_available_slots(
        self, name: str, start: datetime, end: datetime, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """What is stored in the range, with the slot of each row."""
        feature = self.registry[name]
        frame = self.store.read(name, tile(start, end, feature.timescale), columns)
        return frame if frame is not None else self._empty(feature, columns)

    def status(self, name: str, start: datetime, end: datetime) -> list[tuple[Slot, bool]]:
        """Every slot of the range and whether it is stored."""
        slots = tile(start, end, self.registry[name].timescale)
        present = self.store.present(name, slots)
        return [(s, s in present) for s in slots]

    def backfill(
        self, names: Sequence[str], start: datetime, end: datetime, save_dir: str | None = None
    ) -> dict[str, str]:
        """Compute and store several tables, inputs first; all of them if no name is given.

        A feature with missing inputs does not keep the others from being computed.
        """
        report = {}
        wanted = list(names) or list(self.registry)
        for name in [n for n in self.registry.closure(wanted) if n in wanted]:
            try:
                slots = tile(start, end, self.registry[name].timescale)
                found = self._slots(self.registry[name], slots, None, save_dir)
                if found.frame is not None and not (self.registry[name].memoize or save_dir):
                    found.frame.write.format("noop").mode("overwrite").save()
                report[name] = f"{len(found.done)} slots, {len(found.lacking)} missing"
            except (MissingInput, KeyError, ValueError) as problem:
                report[name] = f"failed: {problem}"
        return report

    # -- slots -------------------------------------------------------------------------------------

    def _slots(
        self, feature: Feature, slots: Sequence[Slot], columns: Sequence[str] | None, save_dir: str | None = None
    ) -> Found:
        stored = self.store.entries(feature.name, slots)
        absent = [s for s in slots if s not in stored]
        frames = [self.store.read(feature.name, sorted(stored), columns, stored)] if stored else []
        if save_dir and stored:
            self._save_elsewhere(feature, self.store.read(feature.name, sorted(stored)), sorted(stored), save_dir)
        found = Found(None, set(stored), {}, set(), {s: _leaf(feature, s) for s in stored})
        if absent:
            fresh = self._raw(feature, absent) if feature.loader else self._derived(feature, absent)
            if fresh.frame is not None:
                done = sorted(fresh.done)
                frame = fresh.frame
                if save_dir or feature.memoize:
                    target = SlotStore(self.spark, store_root(save_dir)) if save_dir else self.store
                    if target.root == self.store.root:
                        if not feature.carry:  # a carried feature has stored every step
                            target.write(feature.name, frame, done, rebalance=not feature.loader, made_of=fresh.made_of)
                    else:
                        self._save_elsewhere(feature, frame, done, save_dir)
                    frame = target.read(feature.name, done, columns)
                elif columns is not None:
                    frame = trim_columns(frame, [*columns, "slot_start"])
                frames.append(frame)
            keeps = feature.memoize or feature.carry or feature.loader
            made = {s: _leaf(feature, s) if keeps else fresh.made_of.get(s, frozenset()) for s in fresh.done}
            found = Found(None, set(stored) | fresh.done, fresh.lacking, fresh.skipped, found.made_of | made)
        frames = [f for f in frames if f is not None]
        if frames:
            found.frame = concat_common(*frames)
        return found

    def _save_elsewhere(self, feature: Feature, frame: DataFrame | None, slots: list[Slot], save_dir: str) -> None:
        target = SlotStore(self.spark, store_root(save_dir))
        if target.root == self.store.root or frame is None:
            return
        have = target.present(feature.name, slots)
        rest = [s for s in slots if s not in have]
        if rest:
            target.write(feature.name, frame.where(in_runs("slot_start", rest)), rest)

    def _raw(self, feature: Feature, slots: list[Slot]) -> Found:
        if feature.inputs:
            raise ValueError(f"raw feature {feature.name} must not have inputs")
        lacking = self._raw_lacking(feature, slots)
        have = [s for s in slots if s not in lacking]
        frame = feature.loader.read(self.spark, self.raw_root, have) if have else None
        return Found(frame, set(have), lacking, set())

    def _raw_lacking(self, feature: Feature, slots: list[Slot]) -> dict[Slot, frozenset[str]]:
        if hasattr(feature.loader, "available"):
            there = feature.loader.available(self.spark, self.raw_root, slots)
            return {s: frozenset([f"{feature.name}@{s[0]}"]) for s in slots if s not in there}
        paths = {s: feature.loader.path(self.raw_root, s) for s in slots}
        found = existing(self.spark, paths.values())
        return {s: frozenset([p]) for s, p in paths.items() if p not in found}

    def _derived(self, feature: Feature, slots: list[Slot]) -> Found:
        if feature.carry:
            return self._carried(feature, slots)
        lacking: dict[Slot, frozenset[str]] = {}
        skipped: set[Slot] = set()
        gathered = self._inputs(feature.inputs, slots)
        for slot in slots:
            verdicts = [self._verdict(slot, found, tiles) for found, tiles in gathered]
            for need, (paths, none) in zip(feature.inputs, verdicts):
                if need.on_missing in (ERROR, PARTIAL) and paths:
                    lacking[slot] = lacking.get(slot, frozenset()) | paths
                elif need.on_missing in (ERROR, SKIP) and none:
                    skipped.add(slot)
            if verdicts and all(none for _, none in verdicts):
                skipped.add(slot)
        skipped -= set(lacking)
        good = [s for s in slots if s not in lacking and s not in skipped]
        if not good:
            return Found(None, set(), lacking, skipped)
        frames = [
            self._shifted(need, found, tiles, good) for need, (found, tiles) in zip(feature.inputs, gathered)
        ]
        frame = feature.compute(Context(self.spark, self.settings, good), *frames)
        return Found(frame, set(good), lacking, skipped, {s: self._made_of(s, gathered) for s in good})

    def _inputs(self, needs: Sequence[Input], slots: list[Slot]) -> list[tuple[Found, dict[Slot, list[Slot]]]]:
        """Each input over everything the slots need, and which of its slots each slot needs.

        Inputs that read the same feature at several offsets are resolved together, in one plan.
        """
        tiles = [
            {s: tile(s[0] + i.offset, s[1] + i.offset, self.registry[i.feature].timescale) for s in slots} for i in needs
        ]
        found: dict[str, Found] = {}
        for name in dict.fromkeys(i.feature for i in needs):
            same = [(i, ts) for i, ts in zip(needs, tiles) if i.feature == name]
            every = sorted({t for _, ts in same for some in ts.values() for t in some})
            columns = None
            if all(i.columns is not None for i, _ in same):
                columns = list(dict.fromkeys(c for i, _ in same for c in i.columns))
            found[name] = self._slots(self.registry[name], every, columns)
        return [(found[i.feature], ts) for i, ts in zip(needs, tiles)]

    @staticmethod
    def _verdict(slot: Slot, found: Found, tiles: dict[Slot, list[Slot]]) -> tuple[frozenset[str], bool]:
        """Missing paths of a slot's input, and whether it has no table at all."""
        paths = frozenset().union(*[found.lacking.get(t, frozenset()) for t in tiles[slot]])
        return paths, not any(t in found.done for t in tiles[slot])

    def _shifted(self, need: Input, found: Found, tiles: dict[Slot, list[Slot]], good: list[Slot]) -> DataFrame:
        """The input's rows under the slot they are wanted for; the slot pairs come from the driver."""
        if found.frame is None:
            return self._empty(self.registry[need.feature], need.columns)
        pairs = [(t[0], s[0]) for s in good for t in tiles[s] if t in found.done]
        consumer = step_of(good[0])
        frame = found.frame
        if need.columns is not None:
            frame = trim_columns(frame, [*need.columns, "slot_start"])
        renamed = frame.withColumnRenamed("slot_start", "_input_slot").where(
            in_runs("_input_slot", sorted({t for s in good for t in tiles[s] if t in found.done}))
        )
        if all(floor_to(a - need.offset, consumer) == b for a, b in pairs):
            # Every input slot lies in one slot of the feature: the slot is an expression, not a join.
            return renamed.withColumn("slot_start", slot_column("_input_slot", need.offset, consumer)).drop("_input_slot")
        mapping = self.spark.createDataFrame([(epoch(a), epoch(b)) for a, b in pairs], "a long, b long").select(
            F.timestamp_seconds("a").alias("_input_slot"), F.timestamp_seconds("b").alias("slot_start")
        )
        return renamed.join(mapping, "_input_slot").drop("_input_slot")

    def _carried(self, feature: Feature, slots: list[Slot]) -> Found:
        """Slots of a history: each stretch of missing ones is one plan and one write, from the stored slot before it.

        Slots between the nearest stored one and those asked for are computed as well, and so are stored ones after a slot
        that was missing, whose state it lacks. Without any stored slot before it a history starts from nothing only if
        the settings' ``seed`` is "empty"; else it is an error, as all earlier state would be lost.
        """
        own = next(i for i in feature.inputs if i.feature == feature.name)
        others = [i for i in feature.inputs if i.feature != feature.name]
        first, last = min(slots), max(slots)
        stored = self.store.slots_of(feature.name)
        earlier = [s for s in stored if s < first]
        if not earlier and self.settings.seed != "empty":
            raise ValueError(f'{feature.name} has no stored slot before {first[0]}: set seed="empty" to start it there')
        # What lies between is missing state, not an empty one.
        start = max(earlier)[1] if earlier else first[0]
        missing = sorted({*tile(start, last[1], feature.timescale), *slots} - set(stored))
        stretch = tile(missing[0][0], max([last, *stored])[1], feature.timescale)
        before = tile(stretch[0][0] + own.offset, stretch[0][1] + own.offset, feature.timescale)
        history = self.store.read(feature.name, before)
        gathered = self._inputs(others, stretch)
        loud: list[Slot] = []
        source: dict[Slot, Slot | None] = {}
        lacking: dict[Slot, frozenset[str]] = {}
        for slot in stretch:
            verdicts = [self._verdict(slot, found, tiles) for found, tiles in gathered]
            failed = [paths for need, (paths, _) in zip(others, verdicts) if need.on_missing in (ERROR, PARTIAL) and paths]
            none = all(none for _, none in verdicts)
            if failed or (none and history is None and not loud):
                lacking[slot] = frozenset().union(*(failed or [paths for paths, _ in verdicts]))
                if earlier or source:
                    break
                continue
            if not none:
                loud.append(slot)
            source[slot] = loud[-1] if loud else None
        for slot in stretch:
            if slot not in source and slot not in lacking:
                # The slot before could not be computed, so neither can this one.
                lacking[slot] = frozenset({self.store.slot_path(feature.name, (slot[0] + own.offset, slot[0]))})
        if source:
            frame = self._told(feature, others, gathered, history, loud, source)
            self.store.write(feature.name, frame, sorted(source), made_of={s: self._made_of(s, gathered) for s in source})
        stale = [s for s in stored if s in lacking]
        if stale:
            self.store.retract(feature.name, stale)
        wanted = set(slots)
        done = wanted & set(source)
        frame = self.store.read(feature.name, sorted(done)) if done else None
        return Found(frame, done, {s: p for s, p in lacking.items() if s in wanted}, set())

    def _told(self, feature: Feature, others, gathered, history: DataFrame | None, loud: list[Slot], source) -> DataFrame:
        """Rows of all slots of ``source``; one without input has those of the slot before it."""
        frames = []
        if loud:
            inputs = [self._shifted(n, found, tiles, loud) for n, (found, tiles) in zip(others, gathered)]
            rows = feature.compute(Context(self.spark, self.settings, loud), history, *inputs)
            pairs = [(epoch(s[0]), epoch(of[0])) for s, of in source.items() if of is not None]
            if any(a != b for a, b in pairs):
                named = self.spark.createDataFrame(pairs, "a long, b long").select(
                    F.timestamp_seconds("a").alias("slot_start"), F.timestamp_seconds("b").alias("_of")
                )
                rows = rows.withColumnRenamed("slot_start", "_of").join(named, "_of").drop("_of")
            frames.append(rows)
        quiet = [s for s, of in source.items() if of is None]
        if quiet:
            starts = F.array(*[moment_lit(s[0]) for s in quiet])
            frames.append(history.drop("slot_start").withColumn("slot_start", F.explode(starts)))
        return concat_common(*frames) if len(frames) > 1 else frames[0]

    @staticmethod
    def _made_of(slot: Slot, gathered) -> frozenset[str]:
        return frozenset().union(*[found.made_of.get(t, frozenset()) for found, tiles in gathered for t in tiles[slot]])

    # -- late input --------------------------------------------------------------------------------

    def late_slots(self, name: str, start: datetime, end: datetime) -> list[Slot]:
        """Stored slots of the range that would come out otherwise now: an input came, or was made anew, after them."""
        now = self._now(self.registry[name], tile(start, end, self.registry[name].timescale), {})
        return sorted(s for s, state in now.items() if state.stored and state.late)

    def refresh(self, name: str, start: datetime, end: datetime) -> list[Slot]:
        """Retract the late slots of the range, with those of its inputs they come from, and compute them again."""
        feature = self.registry[name]
        slots = tile(start, end, feature.timescale)
        seen: dict[str, dict[Slot, State]] = {}
        late = sorted(s for s, state in self._now(feature, slots, seen).items() if state.stored and state.late)
        for each, states in seen.items():
            self.store.retract(each, sorted(s for s, state in states.items() if state.stored and state.late))
        if late:
            self._slots(feature, [s for s in slots if s in set(late)], None)
        return [s for s in late if s in set(slots)]

    def _now(self, feature: Feature, slots: Sequence[Slot], seen: dict[str, dict[Slot, State]]) -> dict[Slot, State]:
        """What each slot would be made from now, through all tables that are not stored, and whether that is news."""
        if feature.loader:
            lacking = self._raw_lacking(feature, list(slots))
            return {s: State(_leaf(feature, s) if s not in lacking else frozenset()) for s in slots}
        entries = self.store.entries(feature.name, slots)
        if feature.carry:
            # All stored slots up to the last one asked for: what is late in one is late in all after it.
            slots = sorted({*slots, *[s for s in self.store.slots_of(feature.name) if s <= max(slots)]})
            entries = self.store.entries(feature.name, slots)
        states: dict[Slot, State] = {}
        parts = []
        for need in feature.inputs:
            if need.feature != feature.name:
                source = self.registry[need.feature]
                tiles = {s: tile(s[0] + need.offset, s[1] + need.offset, source.timescale) for s in slots}
                every = sorted({t for own in tiles.values() for t in own})
                parts.append((self._now(source, every, seen), tiles))
        carried = False
        for slot in sorted(slots):
            below = [states_of[t] for states_of, tiles in parts for t in tiles[slot]]
            made = frozenset().union(*[state.made for state in below])
            written = max([state.written for state in below], default=0.0)
            late = any(state.late for state in below)
            entry = entries.get(slot)
            if entry is None:
                states[slot] = State(made, late, written)
                continue
            late = late or carried or written > entry.written_at.timestamp() or (entry.inputs is not None and bool(made - set(entry.inputs)))
            carried = feature.carry and late
            states[slot] = State(_leaf(feature, slot), late, entry.written_at.timestamp(), True)
        seen.setdefault(feature.name, {}).update(states)
        return states

    def _empty(self, feature: Feature, columns: Sequence[str] | None = None) -> DataFrame:
        """A table of the feature's columns without rows."""
        if feature.name not in self._schemas:
            if feature.loader:
                frame = feature.loader.empty(self.spark)
            else:
                inputs = [
                    None if i.feature == feature.name else self._empty(self.registry[i.feature], i.columns)
                    for i in feature.inputs
                ]
                day = (datetime(1970, 1, 1), datetime(1970, 1, 2))
                frame = feature.compute(Context(self.spark, self.settings, [day]), *inputs)
            schema = frame.schema
            if "slot_start" not in schema.names:
                schema = schema.add("slot_start", "timestamp")
            self._schemas[feature.name] = schema
        frame = self.spark.createDataFrame([], self._schemas[feature.name])
        return frame if columns is None else trim_columns(frame, [*columns, "slot_start"])


def store_root(root: str) -> str:
    """Folder of stored tables; raw logs of the same names lie beside it and are never written to."""
    return f"{root.rstrip("/")}/derived"


def step_of(slot: Slot) -> Timescale:
    """Timescale of an aligned slot."""
    for unit in (MONTH, YEAR):
        if is_slot(*slot, unit):
            return unit
    return slot[1] - slot[0]


def slot_column(input_slot: str, offset: timedelta, step: Timescale) -> Column:
    """Slot of length ``step`` that an input slot, shifted back by ``offset``, lies in."""
    seconds = F.unix_timestamp(input_slot) - int(offset.total_seconds())
    if isinstance(step, str):
        return F.date_trunc(step, F.timestamp_seconds(seconds))
    length = int(step.total_seconds())
    return F.timestamp_seconds(F.floor(seconds / length) * length)


def in_runs(column: str, slots: Sequence[Slot]) -> Column:
    """Slot start is one of the slots, written as few ranges."""
    runs: list[list[datetime]] = []
    for start, end in slots:
        if runs and runs[-1][1] == start:
            runs[-1][1] = end
        else:
            runs.append([start, end])
    parts = [(F.col(column) >= moment_lit(a)) & (F.col(column) < moment_lit(b)) for a, b in runs]
    return reduce(or_, parts, F.lit(False))
