"""Segmenters by language. Rules and the lattice are built in; others are taken if their library is installed, or registered."""

from __future__ import annotations

import multiprocessing
import re
import string
from collections.abc import Callable
from functools import lru_cache

from .operators.lattice import Lexicon

GLUE = [re.compile(p) for p in (r"([A-Za-z][A-Za-z0-9.]?)[ 　]([A-Za-z0-9.])",) * 2 + (r"([A-Za-z][0-9.]+)[ 　]([A-Za-z0-9.])",)]
SPACE = str.maketrans("", "", string.whitespace)
WORD = re.compile(r"\.\.\.|--|n't\b|'(?:s|m|d|re|ve|ll)\b|\d+(?:[.,]\d+)*|\w+(?:[-'.]\w+)*(?:\.(?=\S))?|[^\w\s]", re.I)


def glue(sentence: str) -> str:
    for pattern in GLUE:
        sentence = pattern.sub(r"\1_\2", sentence)
    return sentence.translate(SPACE)


def rule_words(sentence: str, known: frozenset[str] = frozenset()) -> list[str]:
    """Words and marks. The stop right behind a known abbreviation (in lower case) stays at it."""
    spaced = re.sub(r"(?i)n't\b", " n't", re.sub(r"(?i)(?<=\w)('(?:s|m|d|re|ve|ll))\b", r" \1", sentence))
    if not known:
        return WORD.findall(spaced)
    out, end = [], -1
    for m in WORD.finditer(spaced):
        if m[0] == "." and m.start() == end and out[-1].lower() in known:
            out[-1] += "."
        else:
            out.append(m[0])
        end = m.end()
    return out


def english() -> Callable[[str], list[str]]:
    try:
        from nltk import word_tokenize
    except ImportError:
        return rule_words
    return word_tokenize


def lattice_words(sentence: str) -> list[str]:
    """Without a lexicon: runs of kana and of Hangul, single Han characters."""
    return no_lexicon().words([sentence])[0]


@lru_cache(maxsize=1)
def no_lexicon() -> Lexicon:
    return Lexicon()


def korean() -> Callable[[str], list[str]]:
    try:
        from konlpy.tag import Mecab
    except ImportError:
        return lattice_words
    return Mecab().morphs


def japanese() -> Callable[[str], list[str]]:
    try:
        from pyknp import Juman
    except ImportError:
        return lattice_words
    juman = Juman()
    return lambda s: [m.midasi for m in juman.analysis(s)]


def chinese() -> Callable[[str], list[str]]:
    try:
        from stanford_segmenter import Segmenter
        from zhconvert import conv2tw
    except ImportError:
        return lattice_words
    segment = Segmenter().tw_segment
    return lambda s: segment(conv2tw(s))


#: Makers of segmenters by language: the extension point for others.
SEGMENTERS: dict[str, Callable[[], Callable[[str], list[str]]]] = {"en": english, "id": english, "ko": korean, "ja": japanese, "zh": chinese}


#: Segmenters of linear work that stops by itself: they run in the worker.
BUILT_IN = (rule_words, lattice_words)


def _serve(requests, run: Callable[[str], list[str]]) -> None:
    """Sentences of a pipe to (done, tokens or error), until the other end is closed."""
    while True:
        try:
            sentence = requests.recv()
        except EOFError:
            return
        try:
            requests.send((True, list(run(sentence))))
        except Exception as error:
            requests.send((False, repr(error)))


class Supervised:
    """A segmenter in a process of its own, which is ended and begun anew when a sentence takes too long, fails or ends it."""

    def __init__(self, make: Callable[[], Callable[[str], list[str]]], first: Callable[[str], list[str]]) -> None:
        self.make, self.ready, self.child = make, first, None

    def start(self) -> None:
        run, self.ready = self.ready or self.make(), None
        context = multiprocessing.get_context("fork")
        self.requests, theirs = context.Pipe()
        self.child = context.Process(target=_serve, args=(theirs, run), daemon=True)
        self.child.start()
        theirs.close()

    def stop(self) -> None:
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.requests.close()
            self.child = None

    def __call__(self, sentence: str, seconds: float) -> list[str]:
        if self.child is None:
            self.start()
        try:
            self.requests.send(sentence)
            if seconds <= 0 or not self.requests.poll(seconds):
                raise TimeoutError(sentence[:80])
            done, answer = self.requests.recv()
        except BaseException:
            self.stop()
            raise
        if not done:
            self.stop()
            raise RuntimeError(answer)
        return answer


@lru_cache(maxsize=16)
def segmenter(lang: str) -> Callable[[str, float], list[str]]:
    """One per worker and language: (sentence, seconds) to tokens. An unknown language is a KeyError, which fails the page."""
    make = SEGMENTERS[lang]
    run = make()
    return (lambda sentence, _: run(sentence)) if run in BUILT_IN else Supervised(make, run)


def sentences(lang: str, text: str) -> list[str]:
    """The lines of a text as they go to a segmenter, without empty ones."""
    lines = text.strip().split("\n")
    return [x for x in (map(glue, lines) if lang in ("ja", "zh") else lines) if x]


def segment(lang: str, text: str, seconds: float = 60.0) -> list[str]:
    """Tokens of all lines. A line whose segmenter fails or takes longer than `seconds` is skipped; the segmenter of a library
    is stopped then, and another one begun for the next line."""
    run, out = segmenter(lang), []
    for sentence in sentences(lang, text):
        try:
            out += run(sentence, seconds)
        except Exception:
            continue
    return out
