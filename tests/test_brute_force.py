"""The line rules against a row-by-row model on random tables."""

import random

import pytest
from helpers import lines, values

from wrenchline.config import EngineConfig, SeqRule
from wrenchline.operators import lines as line_ops, new_tasks

MODES = ("true", "false", "ignore", None)


def random_config(rng):
    rules = tuple(
        SeqRule(
            prefix,
            rng.choice(MODES),
            mhr=rng.choice(MODES),
            newtask=rng.choice(MODES),
            id_method=rng.choice(("-", "/", "all", None)),
            coefficient=rng.choice((0.5, 2.0, None)),
        )
        for prefix in ("2", "3", "8", "10")
    )
    return EngineConfig(rules=rules, default_coefficient=1.25, skip_codes=("vna", " zz "), skip_coefficient=3.0)


def random_rows(rng, n):
    seqs = [None, "1.1", "2", "2.1", "2.2", "3.1", "8.1", "8.2", "10.1", "x"]
    titles = [None, "A-1 (x) / y", "VNA (q", "azZ / k", " EO-5 / cabin ", "plain", "nan", "("]
    minutes = [None, "60", "TBD", "1e2", " 30 ", "-6"]
    return [
        (rng.choice("PQR"), rng.choice(seqs), rng.choice(titles), rng.choice(minutes), rng.choice([None, "e1", "e2", "e3", "e4"]))
        for _ in range(n)
    ]


class Model:
    """The rules for one row, then the order-dependent steps over the rows."""

    def __init__(self, cfg):
        self.cfg = cfg
        self.rules = {r.prefix: r for r in cfg.rules}

    def rule(self, seq):
        return self.rules.get(("nan" if seq is None else seq).split(".")[0])

    def mode(self, seq, sheet):
        rule = self.rule(seq)
        return (rule.mode(sheet) if rule else None) or "true"

    def task_id(self, seq, title):
        rule, text = self.rule(seq), "nan" if title is None else title
        method = (rule.id_method if rule else None) or "/"
        cut = {"-": "(", "/": "/"}.get(method)
        return (text.split(cut)[0] if cut else text).strip()

    def coefficient(self, seq, task):
        if any(code.strip().upper() in task.upper() for code in self.cfg.skip_codes):
            return self.cfg.skip_coefficient
        rule = self.rule(seq) if seq is not None else None
        return self.cfg.default_coefficient if rule is None or rule.coefficient is None else rule.coefficient

    @staticmethod
    def hours(minutes):
        try:
            return float(minutes) / 60.0
        except (TypeError, ValueError):
            return 0.0

    def kept(self, rows, sheet, key):
        seen, out = set(), []
        for number, row in enumerate(rows):
            if self.mode(row[1], sheet) != "ignore" and (row[0], row[key]) not in seen:
                seen.add((row[0], row[key]))
                out.append((number, row))
        return out

    def mhr(self, rows, key):
        out = []
        for number, (_, seq, title, minutes, _) in self.kept(rows, "base", key):
            if seq is not None and self.mode(seq, "mhr") != "ignore":
                task = self.task_id(seq, title)
                factor = self.coefficient(seq, task)
                out.append((number, task, self.mode(seq, "base") == "true", factor, self.hours(minutes) * factor))
        return out

    def new_ids(self, rows, key, known):
        out = []
        for number, (_, seq, title, _, _) in self.kept(rows, "newtask", key):
            task = self.task_id(seq, title)
            kind = "eo" if task.startswith("EO") else "task"
            if self.mode(seq, "newtask") == "true" and (kind, task) not in known:
                out.append((number, task, 0 if kind == "eo" else 1))
        return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("with_event", [False, True])
def test_line_rules(spark, seed, with_event):
    rng = random.Random(seed)
    cfg, rows = random_config(rng), random_rows(rng, 120)
    model, key = Model(cfg), 4 if with_event else 1
    df = lines(spark, "workpack_id seq title planned_min event", *rows)
    if not with_event:
        df = df.drop("event")

    mhr = values(line_ops.mhr_rows(df, cfg), "row_no", "task_id", "check_ref", "coefficient", "adjusted_hours")
    assert sorted(mhr) == model.mhr(rows, key)

    known = {("task", "A-1"), ("eo", "EO-5"), ("task", "plain"), ("eo", "azZ")}
    reference = spark.createDataFrame(sorted(known), "kind string, id string")
    found = new_tasks.new_task_ids(df, reference, cfg)
    assert sorted(values(found, "row_no", "task_id", "source_rank")) == model.new_ids(rows, key, known)
