"""What a user can set for an extraction."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone


@dataclass(frozen=True)
class Options:
    """lang: tokenizer and, for zh, script conversion. max_bytes: size of an output file, at least 200 KiB.
    link_prefixes: prefixes of internal links that are kept (others are removed). as_of: the time that time words
    give; one value for a run, so that a retried task gives what the first one gave. compat: keep the switch function's
    habit of never returning an implicit default. lexicon: a table of pieces and costs by which zh, ja and ko are cut. abbreviations: a table of words
    whose stop stays at them, for the rules of en and id. script: a table of phrases (src, dst) that titles and texts are
    converted by."""

    lang: str = "en"
    max_bytes: int = 1 << 20
    compress: bool = False
    html: bool = False
    links: bool = False
    sections: bool = False
    lists: bool = False
    link_prefixes: tuple[str, ...] = ("w", "wiktionary", "wikt")
    expand_templates: bool = True
    compat: bool = True
    sentence_seconds: float = 60.0
    lexicon: str = ""
    abbreviations: str = ""
    script: str = ""
    as_of: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def keep_links(self) -> bool:
        return self.links or self.html


SMALLEST_FILE = 200 * 1024


def file_size(given: str) -> int:
    """Bytes of a size with a unit letter (K, M or G); the last character is taken as the unit."""
    unit = "kmg".find(given[-1:].lower())
    if unit < 0:
        raise ValueError(f"no unit in size {given!r}")
    size = int(given[:-1]) << 10 * (unit + 1)
    if size < SMALLEST_FILE:
        raise ValueError("an output file holds 200 KiB at least")
    return size
