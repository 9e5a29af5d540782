"""The micro-batch job: the batch operators inside ``foreachBatch``."""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse import schemas as S
from tradepulse.functions import expressions as E
from tradepulse.functions.rules import Rules
from tradepulse.operators import dedup as D
from tradepulse.operators import enrich as J
from tradepulse.operators import metrics as M
from tradepulse.operators import project as P
from tradepulse.operators.ingest import parse_envelopes, unwrap_late
from tradepulse.sources.changes import spread
from tradepulse.sources.state import lookup_bucketed, lookup_state, open_bucketed, write_bucketed
from tradepulse.streaming import late as L
from tradepulse.streaming import totals as R
from tradepulse.streaming.tables import LEDGER_ROW, Kept, StepTables, held, step_after

_COMMON = (
    "src_partition INT, src_offset BIGINT, op STRING, row_id STRING, "
    "event_ts TIMESTAMP, business_date INT"
)


def _record_ddl(kind: str) -> str:
    fields = ", ".join(f"{f.name} {f.type}" for f in S.FIELDS[kind])
    return f"{_COMMON}, {fields}"


PENDING_DDL = {
    kind: f"{_record_ddl(kind)}, attempts INT, first_seen TIMESTAMP"
    for kind in ("fill", "otc", "dept_request")
}
# Stored are a record's fields, but for those that only its first arrival is tested by.
_NOT_STORED = {"order": {"entry_mode", "entry_operator", "report_result", "sec_class"}}
STATE_COLUMNS = {
    kind: ", ".join(
        [f"{f.name} {f.type}" for f in S.FIELDS[kind] if f.name not in _NOT_STORED.get(kind, ())]
        + (["channel STRING"] if kind == "order" else [])
    )
    for kind in ("order", "otc", "dept_request")
}
_STATE_ORDER = "event_ts TIMESTAMP, src_offset BIGINT"
STATE_DDL = {
    kind: f"{columns}, {_STATE_ORDER}, business_date INT" for kind, columns in STATE_COLUMNS.items()
}
SEEN_KEYS = ("business_date", "order_id", "fill_id")
SEEN_DDL = "business_date INT, order_id STRING, fill_id STRING"
QUARANTINE_DDL = "topic STRING, partition INT, offset BIGINT, value STRING, reject_reason STRING"
#: Rows of compacted state that one bucket holds; how many buckets a day has follows from it.
BUCKET_ROWS = 1_000_000
PENDING_KINDS = ("fill", "otc", "dept_request")
#: Tables that a step writes to, but for the ledger.
STEP_TABLES = (
    "quarantine", "kept", "seen/fill",
    *[f"state/{kind}" for kind in ("order", "otc", "dept_request")],
    *[f"{name}/{kind}" for name in ("pending", "expired") for kind in PENDING_KINDS],
)
Typed = dict[str, DataFrame]
Hold = Callable[[DataFrame], DataFrame]
#: Takes a write of a step, to be done with the others or at once.
Put = Callable[[Callable[[], None]], None]
#: Bytes that a waiting record takes about, in its file.
WAITING_BYTES = 32
Days = Iterable[int | None] | None
STATE_KEY = {
    "order": ("business_date", "order_id"),
    "otc": ("business_date", "order_id"),
    "dept_request": ("business_date", "request_id"),
}


def _newest() -> list[Column]:
    return [
        F.col("step").desc(),
        F.col("event_ts").desc_nulls_last(),
        F.col("src_offset").desc_nulls_last(),
    ]


def _together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes at once; Spark shares the executors among them.

    A step has many small writes, and one after another they would leave most
    of a cluster idle. The first failure is raised and fails the batch.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(writes))) as pool:
        inherit = inheritable_thread_target(spark)
        futures = [pool.submit(inherit(write)) for write in writes]
    for future in futures:
        future.result()


@dataclass
class ActivityJob:
    """Everything a run needs besides its input stream.

    ``business_date`` fixes the day; left out, each message counts for its own
    source day. ``strict_reference`` drops unmatched branch-request updates at
    once instead of retrying them. Every ``fold_every`` batches the job folds its
    steps and drops state more than ``keep_days`` days older than ``business_date`` or,
    without one, than the newest source day that no clock contradicts.
    ``fills_once`` drops fills whose id an earlier batch of the day has brought.
    ``publish`` writes the days of the result tables that a batch changes, after it.
    ``parts`` is the number of partitions of a day's totals, fixed for a ``root``. ``parse_partitions``
    deals a batch out to so many tasks if its source has fewer splits. A new
    ``checkpoint`` on the same ``root`` goes on from the totals that are there. A batch is
    read from its source once for its summary and once for each kind in it; ``hold_raw``
    keeps its messages instead, for sources that are dear to read again, like queues. A step of
    more than ``file_rows`` messages or waiting records holds its records in files under ``root``
    and not in memory, does one write after another and drops what it has used up.
    """

    spark: SparkSession
    root: str
    rates: DataFrame
    products: DataFrame
    rules: Rules
    business_date: int | None = None
    zone: str = E.DEFAULT_ZONE
    topics: Mapping[str, str] = field(default_factory=lambda: dict(S.TOPICS))
    fill_limit: L.RetryLimit = L.FILL_LIMIT
    otc_limit: L.RetryLimit = L.OTC_LIMIT
    request_limit: L.RetryLimit = L.REQUEST_LIMIT
    strict_reference: bool = False
    late_topic: str = S.LATE_TOPIC
    fold_every: int | None = 200
    parts: int = 8
    keep_days: int = 1
    publish: bool = False
    fills_once: bool = False
    checkpoint: str | None = None
    parse_partitions: int | None = None
    hold_raw: bool = False
    file_rows: int = 2_000_000

    def __post_init__(self) -> None:
        self.tables = StepTables(self.spark, self.root)
        self.totals = R.Totals(self.tables, self.parts)
        self._clean = False
        self._newest_batch: tuple[str, int] | None = None
        self._run: str | None = None

    # -- running -----------------------------------------------------------

    def start(self, raw: DataFrame, interval: str | None = None):
        """Start on a raw stream: every ``interval``, or once over what is there."""
        writer = (
            raw.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", self._checkpoint())
        )
        if interval is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=interval).start()

    def run_available(self, raw: DataFrame) -> None:
        """Process everything available, then stop."""
        self.start(raw).awaitTermination()

    def _checkpoint(self) -> str:
        return self.checkpoint or f"{self.tables.root}/checkpoint"

    def run_id(self) -> str:
        """Names the checkpoint this job runs from; batches fed by hand share one name."""
        if self._run is None:
            path, fs = self.tables._fs(f"{self._checkpoint()}/metadata")
            if not fs.exists(path):
                return "by hand"
            self._run = json.loads(self.spark.read.text(str(path)).first()[0])["id"]
        return self._run

    def _step_for(self, run: str, batch_id: int) -> tuple[int, bool]:
        """The step of a batch, and whether it is committed already."""
        last = self.tables.last_step()
        self._clear_after(last)
        known = self._newest_batch
        if known is None or known[0] != run or batch_id <= known[1]:
            step = None if last is None else self.tables.step_of(run, batch_id)
            if step is not None:
                return step, True
        return step_after(last), False

    def _clear_after(self, last: int | None) -> None:
        """Drop what a step that failed, here or in an earlier run, has left."""
        if not self._clean:
            self.tables.clear_after(last, STEP_TABLES)
            self.totals.clear_after(last)
            self._clean = True

    def process(self, raw: DataFrame, batch_id: int, run: str | None = None) -> None:
        """One micro-batch; safe to repeat under the same ``run`` and ``batch_id``."""
        run = run or self.run_id()
        step, done = self._step_for(run, batch_id)
        if done:  # all of it is written, but what follows its ledger row may not be
            self._committed(step, [part for part, paths in self.totals.versions().items() if paths[-1].endswith(f"step={step}")])
            return
        self._clean = False
        with held() as hold:
            dealt = spread(raw, self.parse_partitions)
            raw = hold(dealt) if self.hold_raw or dealt is not raw else raw
            # one row per queue partition and kind
            summary = self._envelopes(raw).groupBy("topic", "partition", "kind").agg(
                F.min("offset").alias("min_offset"),
                F.max("offset").alias("max_offset"),
                F.count(F.lit(1)).alias("n"),
                F.max("event_ts").alias("clock"),
                F.count("reject_reason").alias("rejected"),
            ).collect()
            kinds = {row["kind"] for row in summary if row["kind"]}
            is_late = {row["topic"] for row in summary if (row["topic"] or "").upper() == self.late_topic.upper()}
            rejects = any(row["rejected"] and row["topic"] is not None and row["topic"] not in is_late for row in summary)
            clocks = [row["clock"] for row in summary if row["clock"] is not None]
            newest = max(clocks, default=None)
            with self._room(step, sum(row["n"] for row in summary), hold, raw.sparkSession) as room:
                touched = self._step(raw, rejects, bool(is_late), step, kinds, newest, room)
            day = self._day(newest, fold=True)
            self._commit(step, [(*tuple(r)[:2], *tuple(r)[3:6]) for r in summary], run, batch_id, day)
        self._committed(step, touched)
        self._newest_batch = (run, batch_id)
        if self.fold_every is not None and step - (self.tables.last_base("ledger") or 0) >= 2 * self.fold_every:
            self.compact()
            day = self.business_date or self.tables.ledger().agg(F.max("day")).first()[0]
            if day is not None:
                oldest = dt.datetime.strptime(str(day), "%Y%m%d") - dt.timedelta(days=self.keep_days)
                self.expire(int(oldest.strftime("%Y%m%d")))

    def _committed(self, step: int, touched: list[R.Part]) -> None:
        """What follows a ledger row."""
        self._clean = True
        self.totals.drop_older(touched, step)
        if self.publish:
            self.publish_results({day for _, day, _ in touched})

    def drain(self) -> None:
        """End of day: count waiting fills under the default channel, give the rest up."""
        last = self.tables.last_step()
        if last is None or last % 2:
            return
        self._clear_after(last)
        self._clean = False
        with held() as hold, self._room(last + 1, 0, hold) as room:
            touched = self._step(None, False, False, last + 1, set(), None, room, final=True)
            self._commit(last + 1, [], None, None, None)
        self._committed(last + 1, touched)

    @contextlib.contextmanager
    def _room(self, step: int, messages: int, hold: Hold, *sessions: SparkSession) -> Iterator[Hold]:
        """What holds the frames of a step: ``hold``, or files if the step is large."""
        previous = self.tables.last_step(before=step)
        waiting = [] if previous is None else [self.tables.size(self.tables.path(f"pending/{kind}", previous)) for kind in PENDING_KINDS]
        if max(messages, sum(waiting) // WAITING_BYTES) <= self.file_rows:
            yield hold
        else:
            with self.tables.kept(step, *sessions) as kept:
                yield kept

    def _commit(self, step: int, offsets: list[tuple], run: str | None, batch: int | None, day: int | None) -> None:
        rows = [(*row, run, batch, day) for row in offsets or [(None, None, None, None, 0)]]
        names = ("topic", "partition", "min_offset", "max_offset", "n", "run", "batch", "day")
        text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
        ledger = self.spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{LEDGER_ROW}>>")))
        self.tables.write(ledger.withColumn("committed_at", F.current_timestamp()), "ledger", step)

    # -- one step ------------------------------------------------------------

    def _records(self, typed: Typed, kind: str) -> DataFrame | None:
        return P.accepted(typed[kind], kind, self.rules) if kind in typed else None

    def _envelopes(self, raw: DataFrame) -> DataFrame:
        """All messages of a batch without the fields of their records."""
        return parse_envelopes(raw, self.topics, fields=False)

    def _wrapped(self, raw: DataFrame, day: int | None) -> tuple[Typed, DataFrame | None]:
        """Wrapped messages of a batch, typed by kind, and the wrappers that cannot be used."""
        bare = unwrap_late(raw, self.late_topic, kinds=())
        found = bare.groupBy("kind").agg(F.count("reject_reason").alias("rejected")).collect()
        typed: Typed = {}
        for kind in PENDING_KINDS:
            if kind in {row["kind"] for row in found}:
                own = unwrap_late(raw, self.late_topic, kinds=[kind])
                typed[kind] = P.typed_records(own, kind, day, path="$.BASERECORD")
        return typed, P.rejected(bare) if any(row["rejected"] for row in found) else None

    def _step(
        self,
        raw: DataFrame | None,
        rejects: bool,
        has_late: bool,
        step: int,
        kinds: set[str],
        newest: dt.datetime | None,
        hold: Hold,
        final: bool = False,
    ) -> list[R.Part]:
        """Everything a step writes but its ledger row; names the partitions of totals it changed."""
        typed: Typed = {}
        requeued: Typed = {}
        bad: DataFrame | None = None
        clock = None if newest is None else F.lit(newest)
        writes: list[Callable[[], None]] = []
        in_files = isinstance(hold, Kept)
        put: Put = (lambda write: write()) if in_files else writes.append
        if raw is not None:
            bad = self.spark.createDataFrame([], QUARANTINE_DDL)
            if rejects:
                bad = bad.unionByName(P.rejected(self._envelopes(raw).where(F.upper("topic") != self.late_topic.upper())))
            # held are typed fields, not texts: a batch of many messages is kept in little room
            for kind in sorted(kinds):
                own = parse_envelopes(raw, self.topics, kinds=[kind])
                own = P.of_use(P.typed_records(own, kind, self.business_date, self.zone), kind)
                typed[kind] = hold(P.without_text(own))
                bad = bad.unionByName(P.rejected(typed[kind]))
            if has_late:
                wrapped, unusable = self._wrapped(raw, self.business_date or self._day(newest))
                bad = bad if unusable is None else bad.unionByName(unusable)
                for kind, rows in wrapped.items():
                    requeued[kind] = hold(P.without_text(P.of_use(rows, kind) if kind == "fill" else rows))
                    bad = bad.unionByName(P.rejected(requeued[kind]))
            if in_files:  # what follows drops records that it has used up
                self.tables.write(bad, "quarantine", step)
                bad = None
        changed = self._trade(typed, requeued, step, clock, final, hold, put)
        changed += [R.changes(R.ACTIVITY, rows) for rows in self._activity(typed, requeued, step, clock, final, hold, put)]
        touched: list[R.Part] = []
        put(lambda: touched.extend(self.totals.add(changed, step, hold)))
        _together(self.spark, *writes)
        if bad is not None:  # after the others, which have typed the records by now
            self.tables.write(bad, "quarantine", step)
        return touched

    def _day(self, newest: dt.datetime | None, fold: bool = False) -> int | None:
        """Day of the newest source time of a batch; wrapped records carry none themselves.

        For folding there may be none, and a source time ahead of the clock counts as now.
        """
        now = dt.datetime.now(dt.UTC)
        if newest is None and fold:
            return None
        moment = now if newest is None else newest.astimezone()
        if fold:
            moment = min(moment, now)
        return int(moment.astimezone(ZoneInfo(self.zone)).strftime("%Y%m%d"))

    def _pending(self, kind: str, step: int, requeued: Typed, keys: list[str]) -> DataFrame | None:
        """What waits from the step before, and what a former deployment re-queued."""
        previous = self.tables.last_step(before=step)
        waiting = self.tables.read_step(f"pending/{kind}", PENDING_DDL[kind], previous)
        waiting = None if waiting is None or waiting.isEmpty() else waiting
        if kind not in requeued:
            return waiting
        late = self._pending_rows(P.late_accepted(requeued[kind], kind).withColumn("first_seen", F.col("event_ts")), kind)
        both = late if waiting is None else waiting.unionByName(late)
        return D.last_per_key(both, keys, [F.col("event_ts").desc_nulls_last(), F.col("attempts").desc()])

    def _store(self, kind: str, rows: DataFrame, step: int) -> None:
        names = [part.split()[0] for part in STATE_DDL[kind].split(", ")]
        self.tables.write(rows.select(*names), f"state/{kind}", step, ["business_date"])

    def _stored(self, kind: str, wanted: DataFrame, step: int, fresh: DataFrame | None) -> DataFrame:
        """Newest row of each key the batch asks for, of ``fresh`` ones and stored ones.

        Compacted state is bucketed by key and is read where it lies; of the steps since
        then, partitioned by day, the days of the batch are.
        """
        keys = list(STATE_KEY[kind])
        table = f"state/{kind}"
        base = self.tables.last_base(table)
        names = [part.split()[0] for part in STATE_DDL[kind].split(", ")]
        state = self.tables.read(table, STATE_DDL[kind], upto=step - 1, after=base)
        if fresh is not None:
            state = state.unionByName(fresh.select(*names, F.lit(step).cast("bigint").alias("step")))
        if base is not None:
            folded = self._base_state(kind, base)
            if self.business_date is not None:
                folded = folded.where(F.col("business_date") == self.business_date)
            found = lookup_bucketed(folded, wanted, keys[-1], keys[:-1])
            state = state.join(wanted.select(*keys).distinct(), keys, "left_semi").unionByName(found.select(*state.columns))
        if self.business_date is not None:
            state = state.where(F.col("business_date") == self.business_date)
        rows = lookup_state(state, wanted, keys, _newest()) if base is None else D.last_per_key(state, keys, _newest())
        return rows.drop("step", "event_ts", "src_offset")

    def _bucketed(self, kind: str, base: int) -> tuple[str, str]:
        """Name in the catalog, and folder, of compacted state."""
        path = self.tables.path(f"base/state/{kind}", base)
        return f"tradepulse_{kind}_{zlib.crc32(path.encode()):08x}_{base}", path

    def _buckets(self, kind: str, base: int) -> int:
        """Key buckets of a base, as written beside it."""
        return self.tables.read_step(f"buckets/{kind}", "buckets INT", base).first()[0]

    def _base_state(self, kind: str, base: int) -> DataFrame:
        table, path = self._bucketed(kind, base)
        rows = open_bucketed(
            self.spark, table, path, STATE_DDL[kind], STATE_KEY[kind][-1], self._buckets(kind, base), ["business_date"]
        )
        return rows.withColumn("step", F.lit(base).cast("bigint"))

    def _trade(
        self, typed: Typed, requeued: Typed, step: int, clock: Column | None, final: bool,
        hold: Hold, put: Put,
    ) -> list[DataFrame]:
        """Changes of trade totals and customer sets; state and waiting fills go to ``put``."""
        parts: list[DataFrame] = []
        orders = self._records(typed, "order")
        if orders is not None:
            orders = hold(D.dedup_orders(orders))
            self._spent(hold, typed["order"])
            put(lambda: self._store("order", orders, step))
            parts.append(R.trade_changes(M.order_rows(orders), self.rates))
            parts.append(R.customer_changes(orders, "order"))

        fresh = self._records(typed, "fill")
        fresh = None if fresh is None else D.dedup_fills(fresh)
        keys = list(SEEN_KEYS)
        if fresh is not None and self.fills_once:
            seen_before = self.tables.before("seen/fill", SEEN_DDL, step)
            fresh = hold(fresh.join(seen_before.select(*keys), keys, "left_anti"))
            ids = fresh.select(*keys)
            put(lambda: self.tables.write(ids, "seen/fill", step, ["business_date"]))
        waiting = self._pending("fill", step, requeued, keys)
        fills = L.candidates(fresh, waiting, keys)
        if fills is not None:
            if fills is not waiting or requeued or not isinstance(hold, Kept):  # else what waits lies in files
                fills = hold(fills)
            self._spent(hold, fresh, typed.get("fill"), requeued.get("fill"))
            # many fills may be of one order: adaptive execution splits them only if the
            # other side is a plain scan, of what is held, and not a ranking
            stored = hold(self._stored("order", fills, step, orders).select(*STATE_KEY["order"], "channel"))
            tried = hold(J.match_fills(fills, stored, STATE_KEY["order"]))
            self._spent(hold, fills, stored)
            counts = F.col("matched") | (F.lit(True) if final else L.gave_up(self.fill_limit, clock))
            ready = tried.where(counts)
            parts.append(R.trade_changes(M.fill_rows(ready), self.rates))
            parts.append(R.customer_changes(ready, "fill"))
            left = self._pending_rows(L.next_attempt(tried.where(~counts)), "fill")
            put(lambda: self.tables.write(left, "pending/fill", step))
        return parts

    @staticmethod
    def _spent(hold: Hold, *frames: DataFrame | None) -> None:
        if isinstance(hold, Kept):
            hold.spent(*frames)

    def _pending_rows(self, rows: DataFrame, kind: str) -> DataFrame:
        names = [part.split()[0] for part in PENDING_DDL[kind].split(", ")]
        return rows.select(*names)

    def _activity(
        self, typed: Typed, requeued: Typed, step: int, clock: Column | None, final: bool,
        hold: Hold, put: Put,
    ) -> list[DataFrame]:
        """Changes of the daily metrics; state and waiting updates go to ``put``."""
        parts = self._plain_activity(typed)
        parts += self._requests(typed, requeued, step, clock, final, hold, put)
        return parts + self._otc(typed, requeued, step, clock, final, hold, put)

    def _plain_activity(self, typed: Typed) -> list[DataFrame]:
        parts: list[DataFrame] = []
        customers = self._records(typed, "customer")
        if customers is not None:
            parts.append(
                M.activity(M.new_customers(customers), F.concat(F.lit("new_"), F.col("cust_type")))
            )
            parts.append(M.activity(M.closed_customers(customers), "closed"))
        cash = self._records(typed, "cash")
        if cash is not None:
            flow = M.cash_flow(cash, self.rates)
            parts.append(
                M.activity(flow, F.concat(F.lit("cash_"), F.col("direction")), F.col("amount"))
            )
        for kind in ("stock_account", "bank_account", "fund_account"):
            opened = self._records(typed, kind)
            if opened is not None:
                parts.append(M.activity(M.count_rows(opened), kind))
        return parts

    def _requests(
        self, typed: Typed, requeued: Typed, step: int, clock: Column | None, final: bool,
        hold: Hold, put: Put,
    ) -> list[DataFrame]:
        parts: list[DataFrame] = []
        inserts = updates = None
        requests = self._records(typed, "dept_request")
        if requests is not None:
            requests = hold(D.dedup_requests(requests))
            inserts, updates = P.split_by_op(requests)
            put(lambda: self._store("dept_request", inserts, step))
            deals = M.request_deals(inserts)
            parts.append(M.activity(deals, "deal", branch=F.col("branch")))
            updates = M.request_update_candidates(updates)
        keys = ["business_date", "request_id"]
        waiting = self._pending("dept_request", step, requeued, keys)
        tries = L.candidates(updates, waiting, keys)
        if tries is None:
            return parts
        stored = self._stored("dept_request", tries, step, inserts)
        keep = ("branch", "customer_id", "request_date")
        named = tries.withColumnsRenamed({c: f"own_{c}" for c in keep})
        tried = hold(J.enrich_request_updates(named, stored, STATE_KEY["dept_request"]))
        deals = M.count_rows(tried.where(M.is_request_deal()), ("business_date", "branch"))
        parts.append(M.activity(deals, "deal", branch=F.col("branch")))
        give_up = F.lit(True) if final or self.strict_reference else L.gave_up(self.request_limit, clock)
        left = tried.where(~F.col("matched"))
        left = left.drop(*keep).withColumnsRenamed({f"own_{c}": c for c in keep})
        self._put_back(left, give_up, "dept_request", step, put)
        return parts

    def _otc(
        self, typed: Typed, requeued: Typed, step: int, clock: Column | None, final: bool,
        hold: Hold, put: Put,
    ) -> list[DataFrame]:
        parts: list[DataFrame] = []
        inserts = updates = None
        otc = self._records(typed, "otc")
        if otc is not None:
            otc = hold(D.dedup_otc(otc))
            inserts, updates = P.split_by_op(otc)
            put(lambda: self._store("otc", inserts, step))
            outcomes = M.outcome_totals(M.otc_insert_outcomes(inserts, self.products))
            parts.append(M.activity(outcomes, F.col("metric"), F.col("amount")))
            updates = M.otc_update_candidates(updates)
        keys = ["business_date", "order_id"]
        waiting = self._pending("otc", step, requeued, keys)
        tries = L.candidates(updates, waiting, keys)
        if tries is None:
            return parts
        stored = self._stored("otc", tries, step, inserts)
        tried = hold(J.enrich_otc_updates(tries, stored, STATE_KEY["otc"]))
        outcomes = M.outcome_totals(M.otc_update_outcomes(tried))
        parts.append(M.activity(outcomes, F.col("metric"), F.col("amount")))
        give_up = F.lit(True) if final else L.gave_up(self.otc_limit, clock)
        # an unmatched record has nothing filled in, so it is re-queued as it came
        left = tried.where(M.otc_update_outcome().isNull() & ~F.col("matched"))
        self._put_back(left, give_up, "otc", step, put)
        return parts

    def _put_back(self, left: DataFrame, give_up: Column, kind: str, step: int, put: Put) -> None:
        """Unmatched records wait for the next batch, or are kept as expired."""
        again = self._pending_rows(L.next_attempt(left.where(~give_up)), kind)
        over = self._pending_rows(left.where(give_up), kind)
        put(lambda: self.tables.write(again, f"pending/{kind}", step))
        put(lambda: self.tables.write(over, f"expired/{kind}", step))

    # -- reading results ------------------------------------------------------

    # Every reader takes the days to read; left out, all of them are.
    def trade_rows(self, days: Days = None) -> DataFrame:
        return self.totals.rows(R.TRADE, days).select(*M.TRADE_KEYS, *M.TRADE_MEASURES)

    def activity_rows(self, days: Days = None) -> DataFrame:
        return self.totals.rows(R.ACTIVITY, days).select(*M.ACTIVITY_KEYS, *M.ACTIVITY_MEASURES)

    def trade_stats(self, days: Days = None) -> DataFrame:
        """Running trade totals per day, branch and channel."""
        zero = {m: F.coalesce(m, F.lit(0).cast(t)) for m, t in M.TRADE_MEASURES.items()}
        return self.trade_rows(days).withColumns(zero).where("entr_tims <> 0 OR mtch_tims <> 0")

    def customer_stats(self, days: Days = None) -> DataFrame:
        """Distinct order and fill customers per day, branch and channel."""
        counted = self.totals.rows(R.COUNT, days)
        return counted.groupBy(*M.TRADE_KEYS).agg(
            F.coalesce(F.sum(F.when(F.col("metric") == "order", F.col("n"))), F.lit(0)).alias("entr_cust_nums"),
            F.coalesce(F.sum(F.when(F.col("metric") == "fill", F.col("n"))), F.lit(0)).alias("mtch_cust_nums"),
        )

    def customer_day_stats(self, days: Days = None) -> DataFrame:
        return M.customer_day_stats(self.activity_rows(days))

    def branch_day_stats(self, days: Days = None) -> DataFrame:
        return M.branch_day_stats(self.activity_rows(days))

    def otc_day_stats(self, days: Days = None) -> DataFrame:
        return M.otc_day_stats(self.activity_rows(days))

    # Column names of the result tables.
    def trade_result(self, days: Days = None) -> DataFrame:
        """Trade totals and distinct customers on one row per day, branch and channel."""
        both = self.trade_stats(days).join(self.customer_stats(days), list(M.TRADE_KEYS), "left")
        names = {"business_date": "date_id", "branch": "dept", "channel": "trd_chn"}
        people = {c: F.coalesce(c, F.lit(0)) for c in ("entr_cust_nums", "mtch_cust_nums")}
        return both.withColumns(people).withColumnsRenamed(names)

    def results(self, days: Days = None) -> dict[str, DataFrame]:
        """The result tables as of the last step, one row per key, with their write time."""
        tables = {
            "trade": self.trade_result(days), "customer": self.customer_day_stats(days),
            "branch": self.branch_day_stats(days), "otc": self.otc_day_stats(days),
        }
        return {name: df.withColumn("stat_time", E.stat_time()) for name, df in tables.items()}

    def publish_results(self, days: Days = None) -> None:
        """Write the result tables: a day is a partition, replaced as a whole from that day's totals."""
        wanted = None if days is None else set(days)
        if wanted is not None and not wanted:
            return

        def write(name: str, df: DataFrame) -> None:
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("date_id").parquet(self.tables.path(f"results/{name}"))

        _together(self.spark, *[lambda name=name, df=df: write(name, df) for name, df in self.results(wanted).items()])

    def published(self, name: str) -> DataFrame:
        """A result table as last published."""
        return self.spark.read.parquet(self.tables.path(f"results/{name}"))

    def expired(self, kind: str) -> DataFrame:
        """Records whose tries ran out without a match."""
        return self.tables.read(f"expired/{kind}", PENDING_DDL[kind], upto=self.tables.last_step() or 0)

    def waiting(self, kind: str) -> DataFrame:
        """Records still waiting for a match after the last step."""
        rows = self.tables.read_step(
            f"pending/{kind}", PENDING_DDL[kind], self.tables.last_step()
        )
        return self.spark.createDataFrame([], PENDING_DDL[kind]) if rows is None else rows

    def state(self, kind: str) -> DataFrame:
        """Newest stored row per key."""
        return self._state_rows(kind).drop("step", "event_ts", "src_offset")

    def _state_rows(self, kind: str) -> DataFrame:
        table = f"state/{kind}"
        base = self.tables.last_base(table)
        rows = self.tables.read(table, STATE_DDL[kind], upto=self.tables.last_step() or 0, after=base)
        if base is not None:
            rows = rows.unionByName(self._base_state(kind, base))
        return D.last_per_key(rows, STATE_KEY[kind], _newest())

    def quarantined(self) -> DataFrame:
        return self.tables.committed("quarantine", QUARANTINE_DDL)

    # -- housekeeping --------------------------------------------------------

    def compact(self) -> None:
        """Fold all committed steps into one base per table.

        The job does this itself every ``fold_every`` batches. State lies by day and
        is bucketed by key; the number of buckets follows from the rows and is written
        beside the base.
        """
        last = self.tables.last_step()
        if last is None or self.tables.last_base("ledger") == last:
            return
        self.tables.compact("quarantine", self.quarantined().drop("step"), last)
        if self.tables.exists("seen/fill"):
            ids = self.tables.committed("seen/fill", SEEN_DDL).select(*SEEN_KEYS)
            self.tables.compact("seen/fill", ids, last, ["business_date"])
        for kind, keys in STATE_KEY.items():
            rows = self._state_rows(kind).drop("step")
            days = rows.groupBy("business_date").count().agg(F.max("count")).first()[0] or 1
            buckets = -(-days // BUCKET_ROWS)
            counted = self.spark.range(1).select(F.lit(buckets).cast("int").alias("buckets"))
            self.tables.write(counted.coalesce(1), f"buckets/{kind}", last)
            table, path = self._bucketed(kind, last)
            older = self.tables.last_base(f"state/{kind}")
            if older != last:
                write_bucketed(rows, table, path, keys[-1], buckets, ["business_date"])
            self.tables.compact(f"state/{kind}", rows, last)
            if older is not None and older != last:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed(kind, older)[0]}")
            for step in self.tables.steps(f"buckets/{kind}"):
                if step < last:
                    self.tables.clear(f"buckets/{kind}", step)
        # the next step reads what the last one left waiting
        for table in [f"pending/{kind}" for kind in PENDING_KINDS]:
            for step in self.tables.steps(table):
                if step < last:
                    self.tables.clear(table, step)
        self.tables.compact("ledger", self.tables.ledger().drop("step"), last)

    def expire(self, before_day: int) -> int:
        """Drop stored state of days before ``before_day``; returns dropped partitions."""
        daily = [*[f"state/{kind}" for kind in STATE_KEY], "seen/fill"]
        tables = [f"{base}{table}" for table in daily for base in ("", "base/")]
        dropped = sum(self.tables.drop_days(table, before_day) for table in tables)
        for kind in STATE_KEY if dropped else ():  # the catalog learns what is left when a table is opened again
            base = self.tables.last_base(f"state/{kind}")
            if base is not None:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed(kind, base)[0]}")
        return dropped
