"""A budget for a metered model: reserve before a request, settle after it, and a ledger of what a run's passes have spent.

Tasks can't see each other, so each works within a share that was cut before its pass. What it spends comes back as columns of the pass's rows; their
sums are written to the ledger, a table, and the next pass's shares are cut from what the ledger leaves. A run that starts again goes on from there.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.shared import read_if_there, scratch


class BudgetExhausted(RuntimeError):
    """A request would go beyond the budget."""


def usage_cost(prompt_tokens: int, answer_tokens: int, thought_tokens: int = 0, usd_in: float = 1.50, usd_out: float = 7.50) -> float:
    """Prices are for a million tokens; thinking is paid as output."""
    return (prompt_tokens * usd_in + (answer_tokens + thought_tokens) * usd_out) / 1e6


def usage_cost_column(usage: Column, usd_in: float = 1.50, usd_out: float = 7.50) -> Column:
    get = lambda name: F.coalesce(usage[name], F.lit(0))
    return (get("promptTokenCount") * usd_in + (get("candidatesTokenCount") + get("thoughtsTokenCount")) * usd_out) / 1e6


def quota(limit: int, partitions: int, index: int) -> int:
    """A partition's share of a limit; shares add up to it."""
    return limit // partitions + (index < limit % partitions)


@dataclass
class Budget:
    max_usd: float = 5.0
    max_requests: int = 2000
    usd_in: float = 1.50
    usd_out: float = 7.50
    safety: float = 1.25
    reserved_tokens: int = 1024
    requests: int = 0
    reported: float = 0.0
    unreported: float = 0.0
    in_flight: float = 0.0
    exhausted: bool = False

    def share(self, partitions: int, index: int, attempts: int = 1) -> Budget:
        """A partition's part of what is left, for each of its attempts; parts add up to it, so no run of all partitions goes beyond the whole."""
        left = max(0.0, self.max_usd - self.exposure)
        requests = quota(max(0, self.max_requests - self.requests), partitions, index) // attempts
        return Budget(left / partitions / attempts, requests, self.usd_in, self.usd_out, self.safety, self.reserved_tokens)

    def estimate(self, prompt: str) -> float:
        """An upper estimate: a token for each byte."""
        return self.safety * usage_cost(len(prompt.encode()), self.reserved_tokens, 0, self.usd_in, self.usd_out)

    @property
    def exposure(self) -> float:
        return self.reported + self.unreported + self.in_flight

    def begin(self, prompt: str) -> float:
        cost = self.estimate(prompt)
        if self.exhausted or self.requests >= self.max_requests or self.exposure + cost > self.max_usd:
            self.exhausted = True
            raise BudgetExhausted(f"{self.requests} requests, {self.exposure:.4f} USD")
        self.requests += 1
        self.in_flight += cost
        return cost

    def finish(self, reserved: float, actual: float | None) -> None:
        """Settles a reservation; without a reported cost it stays as exposure."""
        self.in_flight = max(0.0, self.in_flight - reserved)
        if actual is None:
            self.unreported += reserved
        else:
            self.reported += actual


#: What a row of a pass has cost: requests that were sent, what the service reported for them, and what was reserved and never reported.
USAGE = "requests long, reported double, unreported double"
_USED = ("requests", "reported", "unreported")


class Ledger:
    """What the passes of a run have spent of one budget: a table with a row a pass.

    `attempts` is how often a task may run: what a task that is run again spent the first time comes back with no row, so a ceiling that must hold even then
    has to be cut into that many parts (`spark.task.maxFailures`).
    """

    def __init__(self, spark: SparkSession, budget: Budget, path: str | None = None, attempts: int = 1) -> None:
        self.spark, self.budget, self.path, self.attempts = spark, budget, path or scratch(spark), attempts

    def spent(self) -> DataFrame:
        """pass, requests, reported, unreported of each pass so far."""
        schema = f"pass string, {USAGE}"
        found = read_if_there(self.spark, self.path, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def left(self) -> Budget:
        """The budget with all that was spent so far on it; its shares are of what is left."""
        r = self.spent().agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _USED)).first()
        return replace(self.budget, requests=self.budget.requests + r["requests"], reported=self.budget.reported + r["reported"], unreported=self.budget.unreported + r["unreported"])

    def record(self, name: str, rows: DataFrame) -> None:
        """Adds what a pass has spent. `rows` have USAGE and must be written down: a pass that is computed again asks, and spends, again."""
        sums = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _USED))
        sums.select(F.lit(name).alias("pass"), *_USED).coalesce(1).write.mode("append").parquet(self.path)
