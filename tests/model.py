"""One-by-one models of what the operators must give, over plain lists."""

from __future__ import annotations

import random


def insert_only(target, source, keys):
    """Rows accepted from ``source`` in order; a key is a tuple of field positions."""
    taken = [set() for _ in keys]

    def values(row):
        return [tuple(row[i] for i in key) for key in keys]

    def hold(row):
        for value, seen in zip(values(row), taken):
            if None not in value:
                seen.add(value)

    for row in target:
        hold(row)
    accepted = []
    for row in source:
        if any(None not in v and v in seen for v, seen in zip(values(row), taken)):
            continue
        hold(row)
        accepted.append(row)
    return accepted


def upsert(target, source, prune=False):
    """(rows by key, writes, deleted) after applying (key, values) rows in order."""
    rows = dict(target)
    deleted = 0
    if prune:
        keys = {k for k, _ in source}
        deleted = sum(k not in keys for k in rows)
        rows = {k: v for k, v in rows.items() if k in keys}
    writes = 0
    for key, values in source:
        if key not in rows or rows[key] != values:
            writes += 1
            rows[key] = values
    return rows, writes, deleted


def strict_violations(target, source):
    """Keys of source rows (key, unique) that fail when checked one by one."""
    held = dict(target)
    bad = []
    for key, value in source:
        clash = value is not None and any(u == value and k != key for k, u in held.items())
        if clash:
            bad.append(key)
        held[key] = value
    return bad


def small(rng: random.Random, nulls=True):
    return rng.choice([None, 0, 1, 2] if nulls else [0, 1, 2])
