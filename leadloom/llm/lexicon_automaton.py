"""A word lexicon as a trie, intersected with the Levenshtein automaton of one edit."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Shorter terms (in characters) are matched exactly only: with one edit they are other words.
MIN_FUZZY_CHARS = 4


class Automaton(NamedTuple):
    """A deterministic automaton over classes of characters. State 0 is dead, state 1 is the start."""

    classes: np.ndarray  # of each code point; those beyond the end have class 0
    width: int
    table: np.ndarray  # next state, at state * width + class
    term: np.ndarray  # of each state: number of the term that is accepted, or -1
    edits: np.ndarray  # of each state: edits of that term
    shortest: int
    longest: int


def code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The characters of UTF-8 bytes, and the places among them of what lies at ``starts`` and ``ends``."""
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    if len(codes) != before[-1]:  # not UTF-8: each byte for itself
        return data.astype("<u4"), starts, ends
    return codes, before[starts], before[ends]


def build(terms: list[str]) -> Automaton:
    """Accepts the terms, and what is one substitution, insertion or deletion (of a character) away from one.

    A state of the product is a set of (trie node, edits so far). Sets are made as they are
    reached, so parts of the Levenshtein automaton that no term can use never exist.
    Of several terms an exact one is taken, else the first in the order given.
    """
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for number, term in enumerate(terms):
        node = 0
        for b in map(ord, term):
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
            node = children[node][b]
        ends.setdefault(node, number)

    used = sorted({ord(c) for t in terms for c in t})
    classes = np.zeros(max(used, default=0) + 2, np.int32)  # class 0: characters of no term
    for i, b in enumerate(used):
        classes[b] = i + 1
    width = len(used) + 1

    def closed(exact: set[int], edited: set[int]) -> tuple[frozenset, frozenset]:
        edited = edited | {c for node in exact for c in children[node].values()}  # deletion
        return frozenset(exact), frozenset(edited - exact)

    def step(state: tuple[frozenset, frozenset], char: int | None) -> tuple[frozenset, frozenset]:
        exact, edited = state
        edited_next = set(exact) | {c for node in exact for c in children[node].values()}  # insertion, substitution
        exact_next = set()
        if char is not None:
            exact_next = {children[node][char] for node in exact if char in children[node]}
            edited_next |= {children[node][char] for node in edited if char in children[node]}
        return closed(exact_next, edited_next)

    start = closed({0}, set())
    numbers = {(frozenset(), frozenset()): 0, start: 1}
    queue, rows = [start], [np.zeros(width, np.int32)]
    for state in queue:
        row = np.zeros(width, np.int32)
        live = {b for nodes in state for node in nodes for b in children[node]}
        for char in [None, *sorted(live)]:
            following = step(state, char)
            if following not in numbers:
                numbers[following] = len(numbers)
                queue.append(following)
            if char is None:
                row[:] = numbers[following]
            else:
                row[classes[char]] = numbers[following]
        rows.append(row)
    term = np.full(len(numbers), -1, np.int32)
    edits = np.zeros(len(numbers), np.int8)
    for (exact, edited), number in numbers.items():
        found = [ends[node] for node in exact if node in ends]
        near = [ends[node] for node in edited if node in ends and len(terms[ends[node]]) >= MIN_FUZZY_CHARS]
        if found:
            term[number] = min(found)
        elif near:
            term[number], edits[number] = min(near), 1
    sizes = [len(t) for t in terms] or [0]
    return Automaton(classes, width, np.concatenate(rows), term, edits, min(sizes) - 1, max(sizes) + 1)


def run(a: Automaton, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (by number) that the automaton accepts, their terms and their edits; all words step side by side."""
    lengths = ends - starts
    active = np.flatnonzero((lengths >= a.shortest) & (lengths <= a.longest))
    state = np.zeros(len(starts), np.int32)
    state[active] = 1
    last = len(a.classes) - 1  # a code point that no term has
    for k in range(a.longest):
        active = active[lengths[active] > k]
        if not len(active):
            break
        following = a.table[state[active] * a.width + a.classes[np.minimum(codes[starts[active] + k], last)]]
        state[active] = following
        active = active[following != 0]
    word = np.flatnonzero(a.term[state] >= 0)
    return word, a.term[state[word]], a.edits[state[word]]


def run_all(
    parts: list[Automaton], first: list[int], codes: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``run`` of a lexicon in several automata, whose terms are numbered from ``first`` each."""
    found = [run(a, codes, starts, ends) for a in parts]
    word, term, edits = (np.concatenate(x) for x in zip(*[(w, t + f, e) for (w, t, e), f in zip(found, first)]))
    order = np.lexsort((term, edits, word))
    order = order[np.concatenate([[True], word[order][1:] != word[order][:-1]])] if len(order) else order
    return word[order], term[order], edits[order]
