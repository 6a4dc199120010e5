"""The two programs written out in plain Python, step by step, as the yardstick for tests.

Tables are dictionaries from key to value; a join of two tables is a union of keys.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pricepanel.schema import BY_WEIGHT_CODES, LEVEL_KEYS

CODE, ARTICLE, PRODUCT, DEPARTMENT, REGION, SIZE, BASE, PRICE, REGIME, YEAR, MONTH = range(11)


def priced(rows):
    out = []
    for q in rows:
        if q[PRICE] is None or q[BASE] is None or not q[SIZE]:
            continue
        value = q[PRICE] * q[BASE] / q[SIZE]
        if value != 0:
            out.append((q, value))
    return out


def in_band(value, reference):
    return reference / 1.25 <= value <= reference * 1.25


def vote(rows):
    votes = defaultdict(Counter)
    for q, _ in rows:
        votes[q[CODE], q[DEPARTMENT]][q[SIZE]] += 1
    return [
        (q, v)
        for q, v in rows
        if q[CODE] in BY_WEIGHT_CODES
        or votes[q[CODE], q[DEPARTMENT]][q[SIZE]] == max(votes[q[CODE], q[DEPARTMENT]].values())
    ]


def product(code):
    if code is None:
        return None
    cut = code[:-1]
    return "1040001" if cut == "10400011" else cut


def dep_prices(rows):
    """(code, region, department) -> (price, n)"""
    groups = defaultdict(list)
    for q, v in rows:
        groups[q[CODE], q[REGION], q[DEPARTMENT]].append(v)
    out = {}
    for key, values in groups.items():
        logs = [math.log(v) for v in values if v > 0]
        out[key] = (math.exp(sum(logs) / len(logs)) if logs else None, len(values))
    return out


def level_prices(dep, level):
    def key(k):
        return {
            "dep": k,
            "reg": k[:2],
            "var": k[:1],
            "prod": (product(k[0]),),
        }[level]

    if level == "dep":
        return dep
    groups = defaultdict(list)
    for k, pn in dep.items():
        groups[key(k)].append(pn)
    return {
        k: (
            math.exp(
                sum(n * math.log(p) for p, n in pns if p is not None) / sum(n for _, n in pns)
            ),
            sum(n for _, n in pns),
        )
        for k, pns in groups.items()
    }


def merge(first, second):
    """Full join: the first price that is there."""
    return {
        k: first.get(k) if first.get(k) is not None else second.get(k)
        for k in first.keys() | second.keys()
    }


def fill_chain(months):
    """Prices per month, first to last -> (backcast, panel) per month."""
    adjusted = [dict(months[-1])]
    for month in reversed(months[:-1]):
        adjusted.insert(0, merge(month, adjusted[0]))
    filled = adjusted[:2]
    for month in adjusted[2:]:
        filled.append(merge(month, filled[-1]))
    return adjusted, filled


def clean_history(quotes, periods, regime_periods):
    """Department prices per month, first to last."""
    cleaned = {}
    following = None
    for period in reversed(periods):
        rows = [q for q in quotes if (q[YEAR], q[MONTH]) == period]
        if period in regime_periods:
            rows = [q for q in rows if q[REGIME] == "IPC-2023"]
        rows = priced(rows)
        if following is not None:
            reference = {(k[0], k[2]): p for k, (p, _) in following.items()}
            kept = []
            for q, v in rows:
                ref = reference.get((q[CODE], q[DEPARTMENT]))
                if in_band(v, v if ref is None else ref):
                    kept.append((q, v))
            rows = kept
        following = dep_prices(vote(rows))
        cleaned[period] = following
    return [cleaned[p] for p in periods]


def history_panels(quotes, periods, regime_periods):
    """level -> period -> key -> price"""
    deps = clean_history(quotes, periods, regime_periods)
    out = {}
    for level in LEVEL_KEYS:
        months = [{k: p for k, (p, _) in level_prices(d, level).items()} for d in deps]
        out[level] = dict(zip(periods, fill_chain(months)[1], strict=True))
    return out


def roll_forward(quotes, panels, period):
    """level -> key -> price of the new month"""
    before = period.previous()
    prior = {level: panels[level][before] for level in panels}
    rows = priced([q for q in quotes if (q[YEAR], q[MONTH]) == period])
    kept = []
    for q, v in rows:
        ref = prior["dep"].get((q[CODE], q[REGION], q[DEPARTMENT]))
        if ref is not None and in_band(v, ref):
            kept.append((q, v))
    dep = dep_prices(vote(kept))
    return {
        level: merge({k: p for k, (p, _) in level_prices(dep, level).items()}, prior[level])
        for level in panels
    }
