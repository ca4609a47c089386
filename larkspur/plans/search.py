"""Search over classifier families and settings, best candidate, soft vote."""

import functools
import time
import uuid
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from larkspur.functions.times import stamped_name
from larkspur.operators import metrics, models
from larkspur.session import small_table

# Names of the metrics a search can optimise; the last two are errors, lower is better.
METRICS = ("Accuracy", "F1", "Precision", "Recall", "AUC", "RMSE", "MAE")


@dataclass
class Candidate:
    name: str
    algorithm: str
    settings: str
    metric: str
    value: float
    seconds: float
    model: PipelineModel


class Found(list):
    """The candidates that ran, and those for which time was out."""

    not_tried = ()
    rungs = ()
    out_of_time = False


def metric_value(scored, target, metric):
    """One metric of scored rows as a number."""
    if metric == "AUC":
        return metrics.roc_auc(scored, target, "probability", 1.0).first()["roc_auc"]
    if metric in ("RMSE", "MAE"):
        return metrics.regression_report(scored, target).first()[metric.lower()]
    names = {"Accuracy": "accuracy", "F1": "f1_score", "Precision": "precision", "Recall": "recall"}
    found = metrics.averages(metrics.class_scores(metrics.confusion(scored, target)))
    return found.first()[names[metric]]


def default_candidates(target, n_features, n_classes=2):
    """(algorithm, settings, classifier, scaled) to try."""
    out = [
        ("logistic", "penalty=0", models.logistic(target), False),
        ("logistic", "penalty=0.1", models.logistic(target, 0.1), False),
        ("forest", "trees=20 depth=5", models.forest(target, 20, 5), False),
        ("forest", "trees=50 depth=8", models.forest(target, 50, 8), False),
        ("perceptron", "hidden=8", models.perceptron(target, n_features, n_classes, rounds=50), True),
    ]
    if n_classes == 2:
        out += [
            ("boosted trees", "rounds=10 depth=4", models.boosted_trees(target, 10, 4), False),
            ("linear svc", "penalty=0.01", models.linear_svc(target, rounds=30), True),
        ]
    return out


def search(train, validation, features, target, candidates=None, metric="Accuracy",
           max_seconds=3600, parallelism=2, clock=time.monotonic):
    """Fit each candidate and measure it on the validation rows.

    No candidate starts after ``max_seconds``; those that run are finished, so none is left behind. The
    ones not started are in the result's ``not_tried``.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric} is not one of {METRICS}")
    if candidates is None or metric == "AUC":
        n_classes = train.select(F.count_distinct(target)).first()[0]
        if metric == "AUC" and n_classes > 2:
            raise ValueError("AUC is for two classes")
    if candidates is None:
        candidates = default_candidates(target, len(features), n_classes)
    train = models.spread(train).persist()
    deadline = clock() + max_seconds

    def run(job):
        number, (algorithm, settings, classifier, scaled) = job
        start = clock()
        if start > deadline:
            return None
        model = models.pipeline(features, classifier, scaled).fit(train)
        value = metric_value(models.predict(model, validation), target, metric)
        return Candidate(f"candidate-{number:02d}", algorithm, settings, metric, value,
                         clock() - start, model)

    with ThreadPoolExecutor(parallelism) as pool:
        jobs = enumerate(candidates, 1)
        found = list(pool.map(inheritable_thread_target(train.sparkSession)(run), jobs))
    train.unpersist()
    out = Found(c for c in found if c is not None)
    out.not_tried = [(f"candidate-{i:02d}", *job[:2], metric) for i, (job, c) in enumerate(zip(candidates, found), 1) if c is None]
    return out


def sample_rows(df, share, salt=""):
    """About ``share`` of the rows, by a hash of all values: a smaller share is part of a larger one, and no run differs from
    another. Copies of a row stay together."""
    if share >= 1:
        return df
    return df.where(F.pmod(F.xxhash64(*df.columns, F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


def halving(train, validation, features, target, candidates=None, metric="Accuracy", first_share=0.125,
            max_seconds=3600, parallelism=2, clock=time.monotonic, tick=0.5):
    """Successive halving: all candidates are fitted on ``first_share`` of the rows, the better half on twice as many, and
    so on, until one is left or all rows are used; the last rung always has all rows.

    Every fit carries a job tag of its own. When ``max_seconds`` are over, the jobs of the fits still running are cancelled by
    their tags, and of the candidates of that rung those count that were finished. The result holds the newest model of every candidate, with
    the rung it got to in ``rungs`` (name, rung, share, value) and whether time ran out in ``out_of_time``; models
    of a higher rung come first. A fit that fails for any other reason is an error.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric} is not one of {METRICS}")
    if not 0 < first_share <= 1:
        raise ValueError("first_share lies above 0 and is at most 1")
    if candidates is None or metric == "AUC":
        n_classes = train.select(F.count_distinct(target)).first()[0]
        if metric == "AUC" and n_classes > 2:
            raise ValueError("AUC is for two classes")
    if candidates is None:
        candidates = default_candidates(target, len(features), n_classes)
    spark, context, run = train.sparkSession, train.sparkSession.sparkContext, uuid.uuid4().hex[:8]
    deadline = clock() + max_seconds
    alive = {f"candidate-{i:02d}": c for i, c in enumerate(candidates, 1)}
    newest, rungs, rung, share, late = {}, [], 0, first_share, False

    def fit(name, rows, tag):
        algorithm, settings, classifier, scaled = alive[name]
        context.addJobTag(tag)
        # A task in the middle of a long step is interrupted, not waited for.
        context.setLocalProperty("spark.job.interruptOnCancel", "true")
        try:
            start = clock()
            model = models.pipeline(features, classifier, scaled).fit(rows)
            value = metric_value(models.predict(model, validation), target, metric)
            return Candidate(name, algorithm, settings, metric, value, clock() - start, model)
        finally:
            context.setLocalProperty("spark.job.interruptOnCancel", None)
            context.removeJobTag(tag)

    while alive and not late:
        if len(alive) == 1:
            share = 1.0
        rows = models.spread(sample_rows(train, share)).persist()
        tags = {name: f"halving-{run}-{rung}-{name}" for name in alive}
        with ThreadPoolExecutor(parallelism) as pool:
            jobs = {pool.submit(inheritable_thread_target(spark)(fit), name, rows, tags[name]): name for name in sorted(alive)}
            running = set(jobs)
            while running:
                running = wait(running, timeout=tick)[1]
                if running and clock() > deadline:
                    late = True
                    for job in running:
                        # Cancelled again at each tick: a fit that has just come to its next job has none to cancel now.
                        if not job.cancel():
                            context.cancelJobsWithTag(tags[jobs[job]])
        rows.unpersist()
        done = {}
        for job, name in jobs.items():
            if job.cancelled():
                continue
            failure = job.exception()
            if failure is None:
                done[name] = job.result()
            elif not late:
                raise failure
        for name, c in sorted(done.items()):
            newest[name] = (rung, c)
            rungs.append((name, rung, float(share), float(c.value)))
        if late or share >= 1:
            break
        kept = [c.name for c in ranked(list(done.values()))][: max(1, (len(done) + 1) // 2)]
        alive = {name: alive[name] for name in kept}
        rung, share = rung + 1, min(1.0, share * 2)
    top = max((r for r, _ in newest.values()), default=0)
    out = Found(c for r in range(top, -1, -1) for c in ranked([c for at, c in newest.values() if at == r]))
    out.rungs, out.out_of_time = rungs, late
    out.not_tried = [(f"candidate-{i:02d}", *job[:2], metric) for i, job in enumerate(candidates, 1) if f"candidate-{i:02d}" not in newest]
    return out


def survivor(found):
    """The best candidate of the highest rung of a halving search."""
    if not found:
        raise LookupError("the search has no candidate")
    return found[0]


def candidates_table(spark, found):
    """One row per candidate; those not tried have no value."""
    rows = [(c.name, c.algorithm, c.settings, c.metric, float(c.value)) for c in found]
    rows += [(*x, None) for x in getattr(found, "not_tried", ())]
    return small_table(
        spark, rows, "candidate string, algorithm string, settings string, metric string, metric_value double"
    )


def ranked(found):
    """Best first; errors are better when smaller; ties go to the earlier candidate."""
    sign = 1 if found and found[0].metric in ("RMSE", "MAE") else -1
    return sorted(found, key=lambda c: (sign * c.value, c.name))


def best(found):
    if not found:
        raise LookupError("the search has no candidate")
    return ranked(found)[0]


def best_rows(table, group, metric, name, smaller_is_better=False):
    """The best candidate of each group in a candidates table; ties go to the smaller ``name``."""
    value = F.col(metric) if smaller_is_better else -F.col(metric)
    best_one = F.min_by(F.struct(name, metric), F.struct(value, F.col(name))).alias("_b")
    return table.where(F.col(metric).isNotNull()).groupBy(group).agg(best_one).select(group, "_b.*")


def best_info(spark, found, base, job, run_ts):
    """One row: model name, search job, candidate, metric and its value."""
    c = best(found)
    row = [(job, c.name, c.metric, float(c.value))]
    table = small_table(
        spark, row, "search_job string, candidate_name string, metric string, metric_value double"
    )
    return table.withColumn("model_name", stamped_name(base, run_ts))


def soft_vote(found, df, top=3):
    """Mean class probabilities of the ``top`` best candidates that have them; the largest decides, equal ones
    for the higher class. ``probability`` is that of class 1 for two classes, else that of the prediction."""
    chosen = [c for c in ranked(found) if models.has_probability(c.model)][:top]
    if not chosen:
        raise LookupError("the search has no candidate with probabilities")
    out = df
    for i, c in enumerate(chosen):
        out = models.probabilities(c.model, out, f"_p{i}")
    total = functools.reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.col(f"_p{i}") for i in range(len(chosen))])
    out = out.select(*df.columns, F.transform(total, lambda x: x / len(chosen)).alias("_mean"))
    best = F.array_max(F.transform("_mean", lambda p, i: F.struct(p.alias("p"), i.alias("i"))))
    shown = F.when(F.size("_mean") == 2, F.get("_mean", F.lit(1))).otherwise(best["p"])
    return out.select(*df.columns, best["i"].cast("double").alias("prediction"), shown.alias("probability"))
