"""Many path globs as one automaton over path parts, so that a path is looked at once.

A glob is a way through a trie: an edge per part, literal or a pattern, and
``**`` parts that stay where they are. A path walks all ways at once. Literal
edges are looked up, as are patterns that are a literal with one ``*`` before or behind it; only
others are tried one by one, and answers for a part are remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Answers for a part at a place of the trie remembered by one task.
REMEMBERED = 200_000

_WILD = re.compile(r"[*?\[]")
_CLASS = re.compile(r"\[(!?)([^\]/]+)\]|(\*)|(\?)|(.)", re.S)

Glob = tuple[str, bool, bool, bool]  # glob, any depth, only directories, also what lies below


def by_parts(glob: str) -> bool:
    """Whether a glob can be taken part by part: no empty part, and ``**`` only as a part of its own."""
    return all(part and (part == "**" or "**" not in part) for part in glob.split("/"))


def _part_regex(part: str) -> str:
    def meaning(m: re.Match) -> str:
        if m[2]:
            return f"[{'^' if m[1] else ''}{m[2]}]"
        return ".*" if m[3] else "." if m[4] else re.escape(m[5])

    return _CLASS.sub(meaning, part)


@dataclass
class _Node:
    literal: dict[str, int] = field(default_factory=dict)
    before: dict[str, int] = field(default_factory=dict)  # literal*
    behind: dict[str, int] = field(default_factory=dict)  # *literal
    pattern: dict[str, int] = field(default_factory=dict)
    stays: bool = False  # any part leads back here
    ends: bool = False  # a path that ends here matches
    below: bool = False  # a path that goes on from here matches


class Automaton:
    """Matches paths against globs; see ``matcher`` for its use as a Column."""

    def __init__(self, globs: list[Glob]):
        self.nodes = [_Node()]
        for glob, deep, only_dirs, subtree in globs:
            self._add(glob.split("/"), deep, only_dirs, subtree)
        self._compiled: dict[str, re.Pattern] = {}
        self._known: dict[tuple[int, str], tuple[int, ...]] = {}

    def _edge(self, table: dict[str, int], key: str) -> int:
        if key not in table:
            table[key] = len(self.nodes)
            self.nodes.append(_Node())
        return table[key]

    def _add(self, parts: list[str], deep: bool, only_dirs: bool, subtree: bool) -> None:
        at = 0
        if deep:
            at = self._edge(self.nodes[0].pattern, "**")
            self.nodes[at].stays = True
        for i, part in enumerate(parts):
            if part == "**":
                if i + 1 == len(parts):
                    # at the end it takes at least one part, and all others
                    at = self._edge(self.nodes[at].pattern, "*")
                    self.nodes[at].stays = True
                else:
                    at = self._edge(self.nodes[at].pattern, "**")
                    self.nodes[at].stays = True
            elif not _WILD.search(part):
                at = self._edge(self.nodes[at].literal, part)
            elif part[0] == "*" and not _WILD.search(part[1:]):
                at = self._edge(self.nodes[at].behind, part[1:])
            elif part[-1] == "*" and not _WILD.search(part[:-1]):
                at = self._edge(self.nodes[at].before, part[:-1])
            else:
                at = self._edge(self.nodes[at].pattern, part)
        self.nodes[at].ends |= not only_dirs
        self.nodes[at].below |= subtree or only_dirs

    def _reached(self, at: int, found: set[int]) -> None:
        """``at`` and what follows it without a part: a ``**`` may take none."""
        if at not in found:
            found.add(at)
            if "**" in self.nodes[at].pattern:
                self._reached(self.nodes[at].pattern["**"], found)

    def _steps(self, at: int, part: str) -> tuple[int, ...]:
        known = self._known.get((at, part))
        if known is not None:
            return known
        node = self.nodes[at]
        found = {at} if node.stays else set()
        if part in node.literal:
            found.add(node.literal[part])
        if node.behind:
            found.update(node.behind[part[i:]] for i in range(len(part) + 1) if part[i:] in node.behind)
        if node.before:
            found.update(node.before[part[:i]] for i in range(len(part) + 1) if part[:i] in node.before)
        for pattern, to in node.pattern.items():
            if pattern == "**":
                continue
            if pattern not in self._compiled:
                self._compiled[pattern] = re.compile(_part_regex(pattern), re.S)
            if self._compiled[pattern].fullmatch(part):
                found.add(to)
        closed: set[int] = set()
        for to in found:
            self._reached(to, closed)
        answer = tuple(sorted(closed))
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        self._known[at, part] = answer
        return answer

    def matches(self, path: str) -> bool:
        now: set[int] = set()
        self._reached(0, now)
        for part in path.split("/"):
            if any(self.nodes[n].below for n in now):
                return True
            now = {to for n in now for to in self._steps(n, part)}
        return any(self.nodes[n].ends for n in now)


def matcher(globs: list[Glob], path: Column) -> Column:
    """Whether a path matches any of ``globs``, all of which are ``by_parts``; null paths match nothing."""
    automaton = Automaton(globs)

    def made(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in chunks:
            yield pa.array([p is not None and automaton.matches(p) for p in chunk.to_pylist()], pa.bool_())

    typed: Callable[[Iterator[pa.Array]], Iterator[pa.Array]] = made
    typed.__annotations__ = {"chunks": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(typed, "boolean")(path)
