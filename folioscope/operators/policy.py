"""Classification by an injected model: routing, response parsing, repair, recall and audit.

The model runs in mapInPandas over a set number of partitions, the only place where something outside Spark is asked. Each pass is
written down before the next reads it, because a lazily repeated pass would ask again.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clip, field, squashed, text_or_blank
from .budget import USAGE, Budget, BudgetExhausted, Ledger, usage_cost

#: A model: title and abstract to its raw response.
Model = Callable[[str, str], str]

# Sources whose papers need a sign of biology before a recall pass may overturn a rejection.
RESTRICTED_SOURCES = ("optica", "optical materials express", "optics express", "optics letters", "prl", "prr", "prx")
# Signs of biology.
BIOLOGY = r"(?iU)\b(?:bio\w*|cell\w*|tissue\w*|protein\w*|peptide\w*|dna|rna|membrane\w*|microscop\w*|imag(?:e|ing)\w*|organism\w*|bacter\w*|virus\w*|neuron\w*|muscle\w*|medical\w*|clinical\w*)\b"


def parse_response(raw: Column, prefix: str = "AI", threshold: int = 50) -> Column:
    """Struct (approved, reason, score, category, explanation) of a model's response: JSON anywhere in it, else a bare TRUE or FALSE."""
    text = field(raw)
    body = F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit("")))
    number = F.try_variant_get(body, "$.score", "double")
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.rint(number))).cast("int")
    category = squashed(text_or_blank(F.try_variant_get(body, "$.category", "string")))
    explanation = squashed(text_or_blank(F.try_variant_get(body, "$.explanation", "string")))
    usable = score.isNotNull() & (category != "") & (explanation != "")
    answer = F.upper(F.regexp_extract(text, r"(?i)^(TRUE|FALSE)\b", 1))
    legacy = answer != ""
    approved = F.when(text == "", False).when(usable, score >= threshold).when(legacy, answer == "TRUE").otherwise(F.lit(False))
    verdict = F.when(approved, F.lit(f"{prefix} Approved")).otherwise(F.lit(f"{prefix} Rejected"))
    return F.struct(
        approved.alias("approved"),
        F.when(text == "", f"{prefix} Unavailable").when(usable | legacy, verdict).otherwise(f"{prefix} Ambiguous Response").alias("reason"),
        F.when(text == "", F.lit(None)).when(usable, score).when(legacy, F.when(approved, 75).otherwise(25)).cast("int").alias("score"),
        F.when(usable, clip(category, 120)).when(legacy & (text != ""), "unspecified").otherwise("").alias("category"),
        F.when(usable, clip(explanation, 600)).when(legacy & (text != ""), "Legacy binary classifier response.").otherwise("").alias("explanation"),
    )


def recall_supported(source: Column, title: Column, abstract: Column, score: Column, least: float = 0.05) -> Column:
    """Whether a recall pass may overturn a rejection: a local score, and for some sources a sign of biology."""
    restricted = F.lower(field(source)).isin(*RESTRICTED_SOURCES)
    text = F.concat_ws(" ", text_or_blank(title), text_or_blank(abstract))
    return (score >= least) & (~restricted | text.rlike(BIOLOGY))


def is_unfinished(reason: Column) -> Column:
    """A first-pass answer that is neither a yes nor a no."""
    return F.startswith(reason, F.lit("AI ")) & ~reason.isin("AI Approved", "AI Rejected")


def is_rejected(reason: Column) -> Column:
    return reason == "AI Rejected"


def ask(papers: DataFrame, model: Model, partitions: int, ledger: Ledger | None = None) -> DataFrame:
    """(seq, raw, requests, reported, unreported): the model's responses and what they cost; a model without a meter costs nothing.

    `partitions` is how many ask at a time; a model that raises has no response. A metered model has what its ledger, or else its own budget, leaves now.
    The rows are dealt to `partitions` shares, and a share stays with its rows in whichever task they are. A model that says it is `local` asks nobody, so its rows go
    to as many tasks as they need.
    """
    ready = model.for_pass(partitions, ledger) if isinstance(model, Metered) else None

    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in source:
            out = []
            for title, abstract, share in zip(rows["title"], rows["abstract"], rows["share"], strict=True):
                try:
                    got = ready.answer(title or "", abstract or "", share) if ready else (model(title or "", abstract or ""), 0, 0.0, 0.0)
                except Exception:  # noqa: BLE001 - whatever the model does, the row is repaired later
                    got = ("", 0, 0.0, 0.0)
                out.append(got)
            yield pd.DataFrame(out, columns=["raw", "requests", "reported", "unreported"], index=rows.index).assign(seq=rows["seq"])[["seq", "raw", "requests", "reported", "unreported"]]

    dealt = papers.select("seq", "title", "abstract", F.pmod(F.xxhash64("seq"), F.lit(partitions)).cast("int").alias("share"))
    placed = dealt.repartition("seq") if getattr(model, "local", False) else dealt.repartitionById(partitions, F.col("share"))
    return placed.mapInPandas(run, f"seq long, raw string, {USAGE}")


def keyword_model(words: tuple[str, ...]) -> Model:
    """A deterministic stand-in for a model, for tests and for runs without one."""

    def model(title: str, abstract: str) -> str:
        import json

        hits = sorted({w for w in words if w in f"{title} {abstract}".lower()})
        return json.dumps({"score": min(100, 30 + 25 * len(hits)), "category": hits[0] if hits else "other", "explanation": f"{len(hits)} of {len(words)} words occur."})

    model.local = True
    return model


def summarize(papers: DataFrame, model: Model, partitions: int, ledger: Ledger | None = None) -> DataFrame:
    """(seq, summary, fell_back) and what each cost: the model's sentence, or the abstract's own first one where the model has none that is complete."""
    from ..functions.text import extractive_summary
    from .quality import summary_issues

    found = papers.select("seq", "abstract").join(ask(papers, model, partitions, ledger), "seq", "left")
    usable = F.coalesce(F.size(summary_issues(F.col("raw"))) == 0, F.lit(False))
    own = extractive_summary(F.col("abstract"))
    return found.select("seq", F.when(usable, field(F.col("raw"))).otherwise(own).alias("summary"), (~usable & (own != "Summary unavailable.")).alias("fell_back"), "requests", "reported", "unreported")


@dataclass(frozen=True)
class Response:
    """What a metered model's service answers."""

    status: int
    text: str = ""
    finish: str = "STOP"
    usage: tuple[int, int, int] | None = None
    wait: float | None = None


def guarded(call: Callable[[str], Response], budget: Budget, retries: int = 3, most_wait: float = 20.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """A prompt's answer within a budget: busy or failing services are asked again after a pause, an answer that was cut off counts as none."""

    def generate(prompt: str) -> str:
        for attempt in range(1, retries + 1):
            reserved = budget.begin(prompt)
            r = Response(0)
            try:
                r = call(prompt)
            except OSError:
                pass
            finally:
                # without a report a request that may have been served stays as exposure; one that was refused costs nothing
                budget.finish(reserved, usage_cost(*r.usage, budget.usd_in, budget.usd_out) if r.usage else 0.0 if 400 <= r.status < 500 else None)
            if r.status == 200:
                return r.text.strip() if r.finish == "STOP" else ""
            if 400 <= r.status < 500 and r.status not in (408, 429):
                return ""
            if attempt < retries:
                sleep(min(r.wait if r.wait is not None else 3.0 * 2 ** (attempt - 1), most_wait))
        return ""

    return generate


class SharedPause:
    """Until when a service wants no request, for all tasks: files in a folder of the shared file system, named by the time they tell.

    A file is written once and never changed, so tasks need no lock; the latest counts. Tasks look again after `every` seconds.
    """

    def __init__(self, folder: str, every: float = 1.0, clock: Callable[[], float] = time.time) -> None:
        self.folder, self.every, self.clock, self._until, self._looked = folder, every, clock, 0.0, -1e18

    def _place(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", self.folder))

    def extend(self, seconds: float) -> None:
        """Keeps all tasks from asking for as many seconds."""
        self._until = max(self._until, self.clock() + seconds)
        fs, path = self._place()
        fs.create_dir(path)
        fs.open_output_stream(f"{path}/{int(self._until * 1000):015d}").close()

    def wait(self) -> float:
        """Seconds that are left to wait."""
        now = self.clock()
        if now - self._looked >= self.every:
            self._looked = now
            fs, path = self._place()
            names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))]
            self._until = max([self._until, *(int(n) / 1000 for n in names if n.isdigit())])
        return max(0.0, self._until - now)


@dataclass
class Metered:
    """A model over a metered service, for `partitions` tasks at a time: each share of a pass has its part of the budget and keeps its part of the least
    interval between requests. A service that asks for a pause gets it from the task that it asked, and from all tasks if there is a `pause`.
    """

    call: Callable[[str], Response]
    prompt: Callable[[str, str], str]
    budget: Budget
    partitions: int
    interval: float = 0.0
    retries: int = 3
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    pause: SharedPause | None = None
    attempts: int = 1

    def __post_init__(self) -> None:
        self._shares, self._next, self._attempt = {}, 0.0, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_shares": {}, "_next": 0.0, "_attempt": None}

    def for_pass(self, partitions: int, ledger: Ledger | None = None) -> Metered:
        """The model with what is left for a pass of so many shares."""
        return replace(self, partitions=partitions, budget=ledger.left() if ledger else self.budget, attempts=ledger.attempts if ledger else self.attempts)

    def _paced(self, prompt: str) -> Response:
        wait = max(self._next - self.clock(), self.pause.wait() if self.pause else 0.0)
        if wait > 0:
            self.sleep(wait)
        self._next = self.clock() + self.interval * self.partitions
        r = self.call(prompt)
        if self.pause and r.status in (408, 429) and r.wait:
            self.pause.extend(r.wait)
        return r

    def answer(self, title: str, abstract: str, share: int = 0) -> tuple[str, int, float, float]:
        """The response, and the requests, reported and unreported cost that it took."""
        context = TaskContext.get()
        if self._attempt != (attempt := context.taskAttemptId() if context else None):
            self._attempt, self._shares = attempt, {}
        if share not in self._shares:
            own = self.budget.share(self.partitions, share, self.attempts)
            self._shares[share] = own, guarded(self._paced, own, self.retries, sleep=self.sleep)
        own, ask_ = self._shares[share]
        before = own.requests, own.reported, own.unreported
        try:
            raw = ask_(self.prompt(title, abstract))
        except BudgetExhausted:
            raw = ""
        return raw, own.requests - before[0], own.reported - before[1], own.unreported - before[2]

    def __call__(self, title: str, abstract: str) -> str:
        return self.answer(title, abstract)[0]


def classify(papers: DataFrame, featured: Column, model: Model, recall_model: Model, keep: Callable[[DataFrame], DataFrame], partitions: int = 4, repair_partitions: int = 2, threshold: int = 50, least_score: float = 0.05, ledger: Ledger | None = None) -> DataFrame:
    """Adds category (featured, regular or null), reason, and the audit of each pass. Papers have local_score.

    `keep` writes a frame down and reads it again; it is called once per pass. Metered models spend from one ledger, the given one or else one over the
    first model's budget, so that all passes together stay within it.
    """
    if ledger is None and (own := next((m.budget for m in (model, recall_model) if isinstance(m, Metered)), None)):
        ledger = Ledger(papers.sparkSession, own)

    def asked(name: str, rows: DataFrame, by: Model, parts: int, prefix: str, alias: str) -> DataFrame:
        found = keep(ask(rows, by, parts, ledger).select("seq", parse_response(F.col("raw"), prefix, threshold).alias(alias), "requests", "reported", "unreported"))
        if ledger and isinstance(by, Metered):
            ledger.record(name, found)
        return found.select("seq", alias)

    routed = papers.withColumn("_featured", featured)
    open_ = routed.where("NOT _featured")
    first = asked("first", open_, model, partitions, "AI", "initial")
    again = open_.join(first.where(is_unfinished(F.col("initial.reason"))).select("seq"), "seq", "left_semi")
    second = asked("repair", again, model, repair_partitions, "AI", "repaired")
    settled = first.join(second, "seq", "left").select("seq", F.coalesce("repaired", "initial").alias("initial"))
    doubted = open_.join(settled.where(is_rejected(F.col("initial.reason"))).select("seq"), "seq", "left_semi")
    recall = asked("recall", doubted, recall_model, repair_partitions, "AI Recall", "recall")
    out = routed.join(settled, "seq", "left").join(recall, "seq", "left")
    supported = recall_supported(F.col("source"), F.col("title"), F.col("abstract"), F.col("local_score"), least_score)
    gated = F.when(F.col("recall.approved") & ~supported, "AI Recall Rejected by Learning Gate").otherwise(F.col("recall.reason"))
    approved = F.col("initial.approved") | (F.coalesce(F.col("recall.approved"), F.lit(False)) & supported)
    out = out.withColumn("reason", F.when(F.col("_featured"), "Featured source or author").otherwise(F.coalesce(gated, F.col("initial.reason"))))
    out = out.withColumn("category", F.when(F.col("_featured"), "featured").when(approved, "regular"))
    final = F.coalesce("recall", "initial")
    for name in ("score", "category", "explanation"):
        out = out.withColumns({f"initial_classifier_{name}": F.col(f"initial.{name}"), f"recall_classifier_{name}": F.col(f"recall.{name}"), f"classifier_{name}": final[name]})
    return out.drop("_featured", "initial", "recall")


def health(results: DataFrame, ledger: Ledger | None = None) -> DataFrame:
    """One row: attempts (a recall is a second one), failures and the failures allowed; with a ledger also the requests, the spend that the service reported
    and the spend that was reserved and never reported."""
    from .quality import allowed_failures

    asked = F.col("category").isNull() | (F.col("category") != "featured")
    recalled = F.col("recall_classifier_score").isNotNull()
    failed = asked & F.col("reason").rlike("Unavailable|Ambiguous|Processing error")
    counts = results.agg((F.sum(asked.cast("int")) + F.sum((asked & recalled).cast("int"))).cast("long").alias("attempts"), F.sum(failed.cast("int")).cast("long").alias("failures"))
    counts = counts.withColumn("allowed", allowed_failures(F.col("attempts")))
    if not ledger:
        return counts
    left = ledger.left()
    return counts.withColumns({"requests": F.lit(left.requests).cast("long"), "reported": F.lit(float(left.reported)), "unreported": F.lit(float(left.unreported))})
