"""Control rules replayed over event tables: rate slots, retries, locks, proxy health, rotations, job checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.operators.fold import fold
from webloom.operators.order import running, slots

#: Browser signatures and languages that requests take in turn.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/123.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:125.0) Gecko/20100101 Firefox/125.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 14.4; rv:125.0) Gecko/20100101 Firefox/125.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 14_4_1) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.4.1 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36 Edg/124.0.0.0",
]
ACCEPT_LANGUAGES = ["en-US,en;q=0.9", "en-GB,en;q=0.9", "en-US,en;q=0.8,es;q=0.5", "en-CA,en;q=0.9,fr;q=0.7"]
MAX_FAILURES, RECOVERY_MS = 3, 300_000
LOCK_SECONDS = 300


def millis(ts: Column) -> Column:
    """Milliseconds of a zoneless timestamp, read as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def rate_slots(events: DataFrame, key: str, at: str, tie: str, gap_ms: int) -> DataFrame:
    """``events`` plus ``slot``: when each may run if one of a key runs in ``gap_ms`` (at least a second), first come first served.

    Closed form of the sequential rule: i * gap + max over earlier ones of (arrival - their i * gap).
    """
    return slots(events, key, [F.col(at).asc(), F.col(tie).asc()], at, max(gap_ms, 1000))


def retry_delay_ms(attempt: Column, base: int = 2000) -> Column:
    """Wait before the next attempt after the n-th failure (from 1), doubling."""
    return (F.lit(base) * F.pow(F.lit(2), attempt - 1)).cast("long")


def retry_schedule(failures: DataFrame, key: str, at: str, tie: str, attempts: int = 3) -> DataFrame:
    """``failures`` plus ``attempt``, ``delay_ms`` and ``exhausted``: null delay once no attempt is left."""
    rows = running(failures, [key], [F.col(at).asc(), F.col(tie).asc()]).withColumn("attempt", F.col("position").cast("int")).drop("position")
    return rows.withColumn("delay_ms", F.when(F.col("attempt") < attempts, retry_delay_ms(F.col("attempt")))).withColumn("exhausted", F.col("attempt") >= attempts)


def replay_locks(requests: DataFrame, key: str, at: str, tie: str, ttl_s: int = LOCK_SECONDS, release: str | None = None) -> DataFrame:
    """(key, at, tie, granted): a lock is granted when the last granted one has expired or been released; times in milliseconds.

    ``release`` names a boolean column: its rows free the lock whoever holds it, and are granted
    nothing.  The rule is sequential in the requests of a key, so a key is one task's stream.
    """

    def step(held, t, _, freed=False):
        if freed:
            return None, (False,)
        free = held is None or t >= held + ttl_s * 1000
        return (t if free else held), (free,)

    found = fold(requests, key, [at, tie], [at, tie, *([release] if release else [])], "granted boolean", lambda: None, step)
    return found.drop(release) if release else found


def proxy_health(events: DataFrame, key: str, at: str, tie: str, failed: str) -> DataFrame:
    """(key, at, tie, failed, failures, healthy) after each event, times in milliseconds.

    Unhealthy from the third failure in a row; a success resets; an unhealthy proxy recovers when
    more than five minutes have passed since its last failure.  Proxies are taken apart, so the reset
    of a pool that is down as a whole does not show here: ``proxy_choices`` replays the pool.
    """

    def step(state, t, _, bad):
        failures, healthy, last = state
        if not healthy and t - last > RECOVERY_MS:
            failures, healthy = 0, True
        if bad:
            failures, last = failures + 1, t
            healthy = healthy and failures < MAX_FAILURES
        else:
            failures, healthy = 0, True
        return (failures, healthy, last), (failures, healthy)

    return fold(events, key, [at, tie], [at, tie, failed], "failures int, healthy boolean", lambda: (0, True, None), step)


def proxy_choices(events: DataFrame, pool: str, at: str, tie: str, failed: str, proxies: list[str]) -> DataFrame:
    """(pool, at, tie, failed, proxy, healthy): which proxy each request takes, and how many are healthy after it; times in milliseconds.

    Before a choice, proxies whose last failure is more than five minutes ago recover.  The healthy
    ones are taken in turn, the turn counted modulo their number; when none is left, all are reset and
    the first is taken.  ``failed`` (null: no) tells how the request ended.  A pool is one stream.
    """

    def start():
        return {p: [True, 0, None] for p in proxies}, 0

    def step(state, t, _, bad):
        pool_, turn = state
        for entry in pool_.values():
            if not entry[0] and t - entry[2] > RECOVERY_MS:
                entry[:2] = True, 0
        healthy = [p for p, entry in pool_.items() if entry[0]]
        if healthy:
            chosen = healthy[turn % len(healthy)]
            turn = (turn + 1) % len(healthy)
        else:
            for entry in pool_.values():
                entry[:2] = True, 0
            chosen = proxies[0] if proxies else None
        if chosen is not None:
            entry = pool_[chosen]
            if bad:
                entry[1:] = entry[1] + 1, t
                entry[0] = entry[0] and entry[1] < MAX_FAILURES
            else:
                entry[:2] = True, 0
        return (pool_, turn), (chosen, sum(entry[0] for entry in pool_.values()))

    return fold(events, pool, [at, tie], [at, tie, failed], "proxy string, healthy int", start, step)


def rotate(number: Column, values: list[str]) -> Column:
    """The value whose turn it is for a running number from 0."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


#: The states of a job.
JOB_STATES = ["discovered", "queued", "running", "completed", "failed", "retrying", "skipped"]


def check_jobs(jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): jobs with a usable url, a hash, a domain, and whole depths and counts that are not negative."""
    from webloom.functions.urls import is_url

    fine = is_url(F.col("url")) & (F.length("url_hash") > 0) & (F.length("domain") > 0)
    for name in ("depth", "max_depth", "retry_count", "max_retries"):
        fine = fine & (F.col(name) >= 0)
    fine = F.coalesce(fine & F.col("state").isin(JOB_STATES), F.lit(False))
    return jobs.where(fine), jobs.where(~fine)


def job_id(session: Column, url_hash: Column) -> Column:
    """A job's name: the same job always has the same one."""
    return F.sha2(F.concat_ws("|", session, url_hash), 256)


def dispatch(jobs: DataFrame, tie: str = "job_id") -> DataFrame:
    """Jobs in the order a queue hands them out: ``place`` from 1, the smallest ``priority`` first (null as 0), then by ``tie``; state ``queued``."""
    ready = check_jobs(jobs)[0].withColumn("priority", F.coalesce("priority", F.lit(0)))
    return running(ready, [], [F.col("priority").asc(), F.col(tie).asc()]).withColumnRenamed("position", "place").withColumn("state", F.lit("queued"))


def latency_percentiles(rows: DataFrame, group: str, value: str, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """(group, p95, p99, n): in constant memory by sketches, off by at most 1 / ``accuracy`` of the ranks; ``exact`` holds every distinct value of a group."""
    at = (lambda p: F.percentile(value, p)) if exact else (lambda p: F.percentile_approx(value, p, accuracy).cast("double"))
    return rows.groupBy(group).agg(at(0.95).alias("p95"), at(0.99).alias("p99"), F.count(value).alias("n"))


def fresh(rows: DataFrame, fetched: str, now: Column, hours: int = 1) -> DataFrame:
    """Cache rows that are not past their time to live."""
    return rows.where(F.col(fetched) > now - F.expr(f"INTERVAL {hours} HOURS"))
