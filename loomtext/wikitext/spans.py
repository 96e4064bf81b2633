"""Places of bracketed regions: braces of any run length, double square brackets, and nested delimiters."""

from __future__ import annotations

import re
from collections.abc import Iterator

CURLY = re.compile(r"\{{2,}|\}{2,}")
ANY = re.compile(r"\{{2,}|\}{2,}|\[{2,}|\]{2,}")
SQUARE = re.compile(r"\[\[|\]\]")


class Depth:
    """Open brackets of one kind: how many there are, and how many there were when each run of them began."""

    def __init__(self) -> None:
        self.now, self.floors = 0, []

    def open(self, n: int) -> None:
        self.floors.append(self.now)
        self.now += n

    def close(self, n: int) -> int:
        """Close up to n brackets; what is left over. A run is used up before the one around it is touched, and a
        single bracket left over then is a stray."""
        to = self.now - n
        stray = to + 1 in self.floors
        surplus = 1 if stray else max(0, -to)
        self.now = to + stray + (0 if stray else surplus)
        while self.floors and self.floors[-1] >= self.now:
            self.floors.pop()
        return surplus


def brace_spans(text: str, least: int = 0) -> Iterator[tuple[int, int]]:
    """Outermost balanced regions. least 2: templates, 3: parameters, 0: any of [[ ]], {{ }} and {{{ }}}.

    Runs of two or more brackets are the tokens. Square brackets count within the braces they stand in: what is open
    there ends with these braces. If all that stays open is the head of the first run, too short to be an opening
    itself, the region begins after that head. The scan ends at the first region that doesn't close."""
    if "{{" not in text and (least or "[[" not in text):
        return
    braces, squares, start = Depth(), [Depth()], -1
    for token in (CURLY if least else ANY).finditer(text):
        kind, size, left = token[0][0], token.end() - token.start(), 0
        if start < 0:
            if kind in "}]" or size < least:
                continue
            start = token.start()
        if kind == "{":
            braces.open(size)
            squares.append(Depth())
        elif kind == "[":
            squares[-1].open(size)
        elif kind == "]":
            left = squares[-1].close(size)
        else:
            left = braces.close(size)
            del squares[len(braces.floors) + 1 :]
            squares[-1] = squares[-1] if len(squares) == 1 else Depth()
        if not braces.now and not squares[0].now:
            yield start, token.end() - left
            start = -1
        elif kind == "}" and 0 < braces.now < least and braces.floors == [0]:
            yield start + braces.now, token.end()
            braces, start = Depth(), -1


def split_parts(text: str) -> list[str]:
    """The text cut at each | outside all bracketed regions."""
    if "|" not in text:
        return [text]
    if "{{" not in text and "[[" not in text:
        return text.split("|")
    bars, at = [], 0
    for start, end in [*brace_spans(text), (len(text), len(text))]:
        bars += [m for m in range(at, start) if text[m] == "|"]
        at = end
    edges = [-1, *bars, len(text)]
    return [text[a + 1 : b] for a, b in zip(edges, edges[1:], strict=False)]


def link_spans(text: str) -> Iterator[tuple[int, int]]:
    """Outermost [[ ]] regions, nested ones inside."""
    if "[[" not in text:
        return
    depth, start = 0, 0
    for m in SQUARE.finditer(text):
        if m[0] == "[[":
            start = start if depth else m.start()
            depth += 1
        elif depth:
            depth -= 1
            if not depth:
                yield start, m.end()


def nested_regions(text: str, opening: str, closing: str) -> list[tuple[int, int]]:
    """Outermost regions between delimiters that may nest, by the depth along both kinds in order. An opening right
    behind a region goes on with it. A region that stays open ends at the last close found in it, or is none without
    one; if openings follow further on, it reaches back to the first region."""
    found = [(*m.span(), kind) for kind, p in ((1, opening), (-1, closing)) for m in re.finditer(p, text, re.I)]
    regions, depth, start, head, last, behind = [], 0, len(text), 0, -1, False
    for at, end, kind in sorted(found):
        if kind > 0:
            if not depth and at != last:
                if last > start:
                    regions.append((start, last))
                start, head = at, end
            behind = depth > 0 and start < last < at
            depth += 1
        elif depth and at >= head:
            depth, last, behind = depth - 1, end, False
    if last > start:
        regions = [(min([start, *(a for a, _ in regions)]), last)] if behind else [*regions, (start, last)]
    return regions


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans. Of overlapping spans the first by (start, end) counts."""
    kept, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            kept.append(text[at:start])
            at = end
    return "".join([*kept, text[at:]])


def drop_nested(text: str, opening: str, closing: str) -> str:
    return cut(text, nested_regions(text, opening, closing))
