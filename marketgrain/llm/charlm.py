"""Character n-grams of words as flat arrays, and sorted hash tables of them.

A word is a run of symbols with a start mark before it and an end mark after it.
Contexts stay inside the word, so a word's probability depends on the word alone
and is worked out once for each different word.
"""

from __future__ import annotations

import numpy as np

from marketgrain.llm import textarrays as ta

START, END = 1, 2  # marks before and after a word
_STEP = ta.U(0xD6E8FEB86659FD93)


def padded(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(symbols with marks, place in the word, word's number, first of each word)."""
    n = ends - starts
    heads = np.cumsum(n + 2) - (n + 2)
    total = int((n + 2).sum())
    out = np.full(total, END, dtype=np.uint64)
    out[heads] = START
    body = ta.gather(heads + 1, n)
    out[body] = symbols[ta.gather(starts, n)].astype(np.uint64) + ta.U(16)
    place = np.arange(total) - np.repeat(heads, n + 2)
    return out, place, np.repeat(np.arange(len(n)), n + 2), heads


def grams(symbols: np.ndarray, place: np.ndarray, orders: int):
    """For k = 1..orders: (key of the k symbols that end here, whether the word
    holds so many)."""
    keys = ta.mix(symbols + ta.U(1000))
    running = keys.copy()
    out = [(ta.mix(running + ta.U(1)), np.ones(len(symbols), dtype=bool))]
    with np.errstate(over="ignore"):
        for k in range(2, orders + 1):
            shifted = np.zeros_like(running)
            shifted[1:] = running[:-1]
            running = ta.mix(shifted * _STEP + keys)
            out.append((ta.mix(running + ta.U(k)), place >= k - 1))
    return out


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key stands in a sorted array, or -1."""
    if not len(table):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def word_scores(tables: list, symbols, place, word, heads, base: float) -> np.ndarray:
    """Sum of log10 probabilities of each word, for every model (columns).

    ``tables[k]`` has ``keys`` (of k+1 symbols), ``own`` (mass that the model
    gives to the last symbol after the k before it) and ``rest`` (weight left to
    the shorter context after these k+1 symbols; 1 if it is no context).
    ``tables[0]`` also has ``rest0``. From the shortest context up,
    p = own + rest * p.
    """
    models = tables[0]["own"].shape[1]
    p = np.full((len(symbols), models), base)
    before = None
    for k, (table, (keys, there)) in enumerate(zip(tables, grams(symbols, place, len(tables)), strict=True)):
        at = find(table["keys"], keys)
        at[~there] = -1
        own = np.where(at[:, None] >= 0, table["own"][at], 0.0)
        if k == 0:
            rest = np.broadcast_to(table["rest0"], (len(symbols), models))
        else:
            rest = np.ones((len(symbols), models))
            known = np.flatnonzero(before[:-1] >= 0) + 1
            known = known[place[known] >= k]
            rest[known] = tables[k - 1]["rest"][before[known - 1]]
        p = own + rest * p
        before = at
    logs = np.log10(np.maximum(p, 1e-300))
    logs[place == 0] = 0.0
    return np.add.reduceat(logs, heads, axis=0) if len(heads) else np.zeros((0, models))
