"""URL filtering with a bit-parallel wildcard automaton.

All glob rules are laid out one after another in the bits of a few machine words. One Shift-And step advances every
pattern over one byte of a URL, and numpy takes the step for a whole batch of URLs at once.

A glob matches a whole host with its path: `*` stands for any run without a slash, `**` for any run, `?` for any
byte but a slash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import small_batches

SLASH = ord("/")
FEW = 32  # texts still unfinished, of which each is read on by itself


@dataclass(frozen=True)
class Glob:
    pattern: str
    verdict: str


@dataclass(frozen=True)
class HostRule:
    """A host with a path prefix, such as `example.net/en/`; it fits the host and all its subdomains."""

    text: str
    verdict: str

    def globs(self) -> list[str]:
        return [f"{self.text}**", f"*.{self.text}**"]


# The rules of the contract.
HOST_RULES = (
    HostRule("net/", "block"), HostRule("example.net/en/", "allow"),
    HostRule("example.com/de/", "block"), HostRule("org/fr/", "allow"),
)
# Files that are no pages, and hosts or folders that hold advertising, logins or trackers.
GLOBS = tuple(Glob(p, "block") for p in (
    "**.jpg", "**.png", "**.gif", "**.zip", "**.exe", "**.mp4", "**.css", "**.js", "ads.*/**", "ad?.*/**", "*.ads.*/**",
    "track*.*/**", "*.doubleclick.*/**", "**/ads/**", "**/login", "**/login/**", "**/signin/**", "**/cart/**",
    "**/checkout/**", "**/wp-admin/**", "**/cgi-bin/**",
))


class Automaton:
    """Shift-And over all patterns at once.

    Bit s of a pattern is set when s of its characters have been read. A byte moves a bit on if it is the next
    character, and leaves a bit in place if a star stands there. The bit before the first character is set at the
    start of a URL only.
    """

    def __init__(self, patterns: Sequence[str]) -> None:
        parsed = [self._parse(p) for p in patterns]
        bits = sum(len(chars) + 1 for chars, _ in parsed)
        self.words = (bits + 63) // 64 or 1
        step = np.zeros((256, self.words), np.uint64)
        stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0

        def mark(table: np.ndarray, bit: int) -> None:
            table[..., bit >> 6] |= np.uint64(1 << (bit & 63))

        for chars, stars in parsed:
            mark(self.start, at)
            for place, kind in stars.items():
                for byte in range(256):
                    if kind == 2 or byte != SLASH:
                        mark(stay[byte], at + place)
            for i, c in enumerate(chars):
                for byte in ([b for b in range(256) if b != SLASH] if c is None else [c]):
                    mark(step[byte], at + i + 1)
            at += len(chars)
            self.final.append((at >> 6, np.uint64(1 << (at & 63))))
            at += 1
        self.step, self.stay = step, stay
        # The same masks as whole numbers.
        self.wide = [[int.from_bytes(row.tobytes(), "little") for row in table] for table in (step, stay)]

    @staticmethod
    def _parse(pattern: str) -> tuple[list[int | None], dict[int, int]]:
        """Bytes (None: any but a slash), and the places of stars: 1 within a segment, 2 over slashes."""
        chars: list[int | None] = []
        stars: dict[int, int] = {}
        for part in pattern.replace("**", "\0").encode("utf-8"):
            if part in (0, ord("*")):
                stars[len(chars)] = max(stars.get(len(chars), 0), 2 if part == 0 else 1)
            else:
                chars.append(None if part == ord("?") else part)
        return chars, stars

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: text by pattern."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order] if len(texts) else lengths
        data, sizes = np.frombuffer(b"".join(texts), np.uint8), lengths[order]
        state = np.tile(self.start, (len(texts), 1))
        for i in range(int(sizes[0]) if len(texts) else 0):
            n = int(np.searchsorted(-sizes, -i, side="left"))  # texts longer than i come first
            if n <= FEW:
                for k in range(n):
                    state[k] = self._read_on(state[k], data[starts[k] + i:starts[k] + sizes[k]].tobytes())
                break
            byte, now = data[starts[:n] + i], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.zeros((len(texts), len(self.final)), bool)
        for k, (word, bit) in enumerate(self.final):
            found[order, k] = (state[:, word] & bit) != 0
        return found

    def _read_on(self, state: np.ndarray, rest: bytes) -> np.ndarray:
        """The state after the rest of one text. No step leads to the bit before a pattern, so none runs into the next one."""
        step, stay = self.wide
        now = int.from_bytes(state.tobytes(), "little")
        for byte in rest:
            now = (now << 1) & step[byte] | now & stay[byte]
        return np.frombuffer(now.to_bytes(8 * self.words, "little"), np.uint64)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path) after the first `://`; both empty where there is none or the url is null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def judge_urls(pages: DataFrame, rules: Sequence[HostRule] = HOST_RULES, globs: Sequence[Glob] = GLOBS,
               default: str = "allow") -> DataFrame:
    """Per page (page_id, url): host, path, the longest host rule that fits or null, the verdict, and the first glob that
    matches or null. Where no host rule fits, the globs decide in their order, and `default` where none matches.

    A null url, or one without `://`, has an empty host and path, which no host rule fits. Urls of any length are
    read whole, repeated rows are judged each, null page_ids are kept, other columns are ignored, an empty
    table gives no rows. Rules of equal length: the first listed wins.
    """
    ranked = sorted(rules, key=lambda r: -len(r.text))
    patterns = [g for r in ranked for g in r.globs()] + [g.pattern for g in globs]
    names = pa.array([r.text for r in ranked] + [None], pa.string())
    by_rule = np.array([r.verdict for r in ranked] + [""], object)
    glob_names = pa.array([g.pattern for g in globs] + [None], pa.string())
    by_glob = np.array([g.verdict for g in globs] + [default], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(patterns)
        for batch in small_batches(batches, 4096):
            page, host, path = batch.columns
            found = automaton.match([h + p for h, p in zip(host.cast(pa.binary()).to_pylist(), path.cast(pa.binary()).to_pylist())])
            fits = np.ones((len(found), len(ranked) + 1), bool)
            fits[:, :-1] = found[:, 0:2 * len(ranked):2] | found[:, 1:2 * len(ranked):2]
            hits = np.ones((len(found), len(globs) + 1), bool)
            hits[:, :-1] = found[:, 2 * len(ranked):]
            rule, glob = fits.argmax(1), hits.argmax(1)
            verdict = np.where(rule < len(ranked), by_rule[rule], by_glob[glob])
            yield pa.RecordBatch.from_arrays(
                [page, host, path, names.take(pa.array(rule)), pa.array(verdict, pa.string()), glob_names.take(pa.array(glob))],
                names=["page_id", "host", "path", "rule", "verdict", "glob"])

    host, path = split_url(pages["url"])
    slim = pages.select(pages["page_id"].cast("long"), host.alias("host"), path.alias("path"))
    return slim.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, glob string")
