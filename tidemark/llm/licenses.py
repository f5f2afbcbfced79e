"""Operator 9: license scans by template markup.

Templates are license texts in the markup of license lists: <<beginOptional>> ... <<endOptional>> encloses wording that
may be absent, <<var;name=...;match=...>> stands for wording that the pattern matches. Each is compiled into an automaton
over words. A text is accepted where all mandatory wording stands word for word, in order, with nothing else between.
All templates run from each place where one of them can begin.

The library (`library()`, the files of license_texts) has whole license texts and the notices that licenses ask for in
files, besides short one-line mentions; a folder of more files, or a dictionary, is a parameter. Patterns are made of
words, groups (a|b), ? after a word or group, and . with a quantifier: .+ .* .{a,b}, a run of any words of at most that
many characters (words and one space between two), 5,000 where no bound is given, as license lists do.

One pass over the texts, no shuffle. Nulls are empty texts; long ones are scanned whole; repeated rows give repeated
results, an empty table an empty one; of several ways to accept wording at a place the longest counts; other columns
don't matter, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Phrases of the base scan and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label: template of one-line mentions.
MENTIONS = {
    "notice-gpl": "<<beginOptional>>this work is<<endOptional>> licensed under the gnu general public license <<beginOptional>>version <<var;name=version;match=.{1,7}>><<endOptional>>",
    "notice-apache": "licensed under the apache license version <<var;name=version;match=.{1,7}>>",
    "notice-cc": "<<beginOptional>>this work is<<endOptional>> licensed under <<beginOptional>>a<<endOptional>> cc <<var;name=terms;match=(by|zero|0)>> <<var;name=more;match=(sa|nd|nc|nc sa|nc nd)?>> <<beginOptional>><<var;name=version;match=(1|2|3|4) (0|5)>><<endOptional>>",
    "notice-mit": "<<beginOptional>>this <<var;name=what;match=.{1,30}>> is<<endOptional>> released under the mit license",
    "rights-reserved": "all rights reserved",
}
#: Characters that a run of any words takes where its pattern has no bound.
RUN = 5_000
TOKEN = re.compile(r"\.(?:\+|\*|\{(\d+),(\d+)\})|([()|?])|([^().|?]+|\.)")


def library(folder: str | Path | None = None) -> dict[str, str]:
    """Label (the file's name) -> template, of a folder of .txt files."""
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted(Path(folder or Path(__file__).parent / "license_texts").glob("*.txt"))}


class Automaton:
    """States of one template: `step[state]` gives, by word, the next states; `skip[state]` those reached without a word; `run[state]` the characters a run of any words may take that begins there, and the state of its words."""

    def __init__(self, markup: str) -> None:
        self.step: list[dict[bytes, list[int]]] = [defaultdict(list)]
        self.skip: list[list[int]] = [[]]
        self.run: dict[int, tuple[int, int]] = {}
        self.inside: set[int] = set()
        at, opened = 0, []
        for part in re.split(r"(<<.*?>>)", markup.lower(), flags=re.S):
            if part == "<<beginoptional>>":
                opened.append(at)
            elif part == "<<endoptional>>":
                if not opened:
                    raise ValueError("an optional region ends that hasn't begun")
                at = self._join(at)
                self.skip[opened.pop()].append(at)
            elif part.startswith("<<var"):
                at = self._pattern(at, re.search(r"match=(.*)>>$", part, re.S)[1])
            elif part.startswith("<<"):
                raise ValueError(f"not markup: {part}")
            else:
                at = self._words(at, part)
        if opened:
            raise ValueError("an optional region isn't closed")
        self.final = at
        self.start = self.closure({0: 0})
        if any(s in self.run for s in self.start) or self.final in self.start:
            raise ValueError("a template begins with fixed wording")
        self.first = {w for s in self.start for w in self.step[s]}

    def _new(self) -> int:
        self.step.append(defaultdict(list))
        self.skip.append([])
        return len(self.step) - 1

    def _join(self, at: int) -> int:
        """A state of its own after `at`, so that what ends here isn't what begins here."""
        end = self._new()
        self.skip[at].append(end)
        return end

    def _words(self, at: int, text: str) -> int:
        for w in WORD.findall(text.encode()):
            nxt = self._new()
            self.step[at][w].append(nxt)
            at = nxt
        return at

    def _pattern(self, at: int, pattern: str) -> int:
        tokens = [m for m in TOKEN.finditer(pattern)]
        if "".join(m[0] for m in tokens) != pattern:
            raise ValueError(f"can't read the pattern {pattern}")
        end, rest = self._either(at, tokens, 0)
        if rest != len(tokens):
            raise ValueError(f"can't read the pattern {pattern}")
        return end

    def _either(self, at: int, tokens: list, i: int) -> tuple[int, int]:
        ends, here = [], self._join(at)
        while i < len(tokens) and tokens[i][0] != ")":
            m = tokens[i]
            if m[0] == "|":
                ends.append(here)
                here, i = self._join(at), i + 1
                continue
            before = here
            if m[0] == "(":
                here, i = self._either(here, tokens, i + 1)
                if i >= len(tokens):
                    raise ValueError("a group isn't closed")
            elif m[0].startswith(".") and len(m[0]) > 1:
                least, most = (int(m[1]), int(m[2])) if m[1] else (int(m[0] == ".+"), RUN)
                inner, end = self._new(), self._new()
                self.run[here] = (most, inner)
                self.inside.add(inner)
                self.skip[inner].append(end)
                if not least:
                    self.skip[here].append(end)
                here = end
            elif m[0] == "?":
                raise ValueError("nothing before ?")
            else:
                here = self._words(here, m[0])
            i += 1
            if i < len(tokens) and tokens[i][0] == "?":
                here = self._join(here)
                self.skip[before].append(here)
                i += 1
            here = self._join(here)
        end = self._new()
        for e in [*ends, here]:
            self.skip[e].append(end)
        return end, i

    def closure(self, states: dict[int, int]) -> dict[int, int]:
        """With the states reached without a word. A state's value is what is left of its run."""
        out, todo = dict(states), list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in out:
                    out[s] = 0
                    todo.append(s)
        return out

    def match(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted run of words from `at`, or -1."""
        states, best, i = self.start, -1, at
        while states:
            if self.final in states:
                best = i
            if i == len(words):
                break
            w, nxt = words[i], {}
            for s, left in states.items():
                for t in self.step[s].get(w, ()):
                    nxt.setdefault(t, 0)
                if s in self.run:
                    most, t = self.run[s]
                    if most >= (n := len(w.decode())):
                        nxt[t] = max(nxt.get(t, 0), most - n)
                if s in self.inside and left > (n := len(w.decode())):
                    nxt[s] = max(nxt.get(s, 0), left - n - 1)
            states = self.closure(nxt)
            i += 1
        return best


class Scanner:
    def __init__(self, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> None:
        self.automata = {k: Automaton(v) for k, v in (MENTIONS | library() if templates is None else templates).items()}
        self.begin: dict[bytes, list[str]] = defaultdict(list)
        for k, a in self.automata.items():
            for w in a.first:
                self.begin[w].append(k)
        self.phrases = [(tuple(WORD.findall(p.encode())), k) for p, k in (PHRASES if phrases is None else phrases).items()]
        self.head: dict[bytes, list] = defaultdict(list)
        for p, k in self.phrases:
            self.head[p[0]].append((p, k))
        self.firsts = set(self.begin) | set(self.head)

    def __call__(self, text: str | None) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score, spans (label, first word, end)."""
        words = WORD.findall((text or "").encode().lower())
        base, labels, starts, spans = set(), set(), [], []
        firsts, n = self.firsts, len(words)
        for i in [i for i, w in enumerate(words) if w in firsts]:
            for p, k in self.head.get(words[i], ()):
                if tuple(words[i : i + len(p)]) == p:
                    base.add(k)
                    starts.append(i)
            for k in self.begin.get(words[i], ()):
                if (end := self.automata[k].match(words, i)) > i:
                    labels.add(k)
                    spans.append((k, i, end))
        score = 1.0 if labels else 0.5 if base else 0.0
        return n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score, spans


def scan(docs: DataFrame, *, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, the base scan's columns, labels, score, and spans (label, first word, end) of accepted wording."""

    templates = MENTIONS | library() if templates is None else templates  # read once, here

    def run(batches):
        scanner = Scanner(templates)
        for whole, at in ((b, at) for b in batches for at in range(0, b.num_rows, 1024)):
            batch = whole.slice(at, 1024)
            got = [scanner(t) for t in batch.column(1).to_pylist()]
            cols = list(zip(*got)) or [()] * 8
            spans = [[{"label": k, "first": a, "end": b} for k, a, b in s] for s in cols[7]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds)], pa.array(spans, span_kind)], names=names)

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    span_kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
