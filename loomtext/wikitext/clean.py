"""From wikitext to plain text: one page at a time."""

from __future__ import annotations

import re
from html.entities import name2codepoint
from urllib.parse import quote

from ..options import Options
from .spans import cut, drop_nested, link_spans
from .templates import Expander

# Element names, protocols and switches of the markup.
DISCARDED = (
    "gallery timeline noinclude pre table tr td th caption div form input select option textarea ul li ol dl dt dd menu dir "
    "ref references img imagemap source small sub sup"
).split()
SELF_CLOSING = "br hr nobr ref references nowiki".split()
IGNORED = "abbr b big blockquote center cite em font h1 h2 h3 h4 hiero i kbd nowiki p plaintext s span strike strong tt u var".split()
PLACEHOLDERS = {"math": "formula", "code": "codice"}
PROTOCOLS = (
    "bitcoin: ftp:// ftps:// geo: git:// gopher:// http:// https:// irc:// ircs:// magnet: mailto: mms:// news: nntp:// redis:// "
    "sftp:// sip: sips: sms: ssh:// svn:// tel: telnet:// urn: worldwind:// xmpp: //"
).split()
SWITCHES = (
    "__NOTOC__ __FORCETOC__ __TOC__ __NEWSECTIONLINK__ __NONEWSECTIONLINK__ __NOGALLERY__ __HIDDENCAT__ __NOCONTENTCONVERT__ "
    "__NOCC__ __NOTITLECONVERT__ __NOTC__ __START__ __END__ __INDEX__ __NOINDEX__ __STATICREDIRECT__ __DISAMBIG__"
).split()
LATE_SWITCHES = [s for s in SWITCHES if s != "__END__"] + ["__NOEDITSECTION__"]

# What the markup's grammar takes for labels, external links, images, trails and highlighted source.
SWITCH = re.compile("|".join(SWITCHES))
LATE_SWITCH = re.compile("|".join(LATE_SWITCHES))
LABEL = r"[^\]\[\x00-\x08\x0a-\x1f]"
EXTERNAL = re.compile(
    rf"\[((?i:{'|'.join(map(re.escape, PROTOCOLS))})[^\]\[<>\"\x00-\x20\x7f\s]+)\s*((?:{LABEL}|\[\[{LABEL}+\]\])*?)\]", re.S
)
IMAGE = re.compile(r"https?://[^\]\[<>\"\x00-\x20\x7f\s]+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x80-\xff]+\.(?i:gif|png|jpe?g)")
TRAIL = re.compile(r"\w*")
HIGHLIGHT = re.compile(r"&lt;syntaxhighlight .*?&gt;(.*?)&lt;/syntaxhighlight&gt;", re.S)
ENTITY = re.compile(r"&#?(\w+);")
COMMENT = re.compile(r"<!--.*?-->", re.S)
#: Name of a tag and what is dropped of it.
DROPPED_TAGS = [
    *[(t, re.compile(rf"<\s*{t}\b[^>]*/\s*>", re.S | re.I)) for t in SELF_CLOSING],
    *[(t, re.compile(p, re.S | re.I)) for t in IGNORED for p in (rf"<{t}\b.*?>", rf"</\s*{t}>")],
]
#: Names behind each < of a text.
TAG_NAME = re.compile(r"<\s*(?:/\s*)?(\w+)")
LINK_TAGS = [("a", re.compile(p, re.S | re.I)) for p in (r"<a\b.*?>", r"</\s*a>")]
DISCARDED_TAGS = [(t, rf"<\s*{t}\b[^>/]*>", rf"<\s*/\s*{t}>") for t in DISCARDED]
HEADER = re.compile(r"(==+)\s*(.*?)\s*\1")
LIST_MARKS = "*#;:"
MARKED = re.compile(r"([*#;:]+)(.*)", re.S)
#: Lists of the markup in HTML: tag of the list and of its items, by mark.
LIST_TAGS = {"*": ("ul", "li"), "#": ("ol", "li"), ";": ("dl", "dt"), ":": ("dl", "dd")}


def tag_names(text: str) -> frozenset[str] | None:
    """Names in lower case that stand behind a < or </ of a text; a pattern of another name can't match there. None if one
    isn't ASCII, as letters of other alphabets count as ASCII ones where case doesn't."""
    names = frozenset(x.lower() for x in TAG_NAME.findall(text)) if "<" in text else frozenset()
    return names if all(map(str.isascii, names)) else None


def unescape(text: str) -> str:
    """Character references and named entities to characters, in one pass; unknown ones stay."""
    if "&" not in text:
        return text

    def one(m: re.Match) -> str:
        code = m[1]
        try:
            if m[0][1] != "#":
                return chr(name2codepoint[code])
            number = int(code[1:], 16) if code[0] == "x" else int(code)
            return m[0] if 0xD800 <= number < 0xE000 else chr(number)
        except (KeyError, ValueError, OverflowError):
            return m[0]

    return ENTITY.sub(one, text)


def unescape_outside_highlight(text: str) -> str:
    """Entities decoded but for the bodies of highlighted source, whose wrappers go."""
    if "&" not in text:
        return text
    pieces = HIGHLIGHT.split(text)
    return "".join(p if i % 2 else unescape(p) for i, p in enumerate(pieces))


def external_links(text: str, options: Options) -> str:
    def one(m: re.Match) -> str:
        label = m[2]
        if IMAGE.fullmatch(label):
            label = f'<img src="{label}" alt="">' if options.keep_links else ""
        return f'<a href="{quote(m[1])}">{label}</a>' if options.keep_links else label

    return EXTERNAL.sub(one, text) if "[" in text else text


def link_text(title: str, label: str, options: Options) -> str:
    """What a link shows: nothing if its title names another namespace than those whose links are kept."""
    namespace = re.match(r":?([^:]+):", title)
    if namespace and namespace[1] not in options.link_prefixes:
        return ""
    return f'<a href="{quote(title)}">{label}</a>' if options.keep_links else label


def link_parts(inner: str) -> tuple[str, str]:
    """Title and label. The label begins after the last outer bar before the last nested link, or after the first bar."""
    first = inner.find("|")
    if first < 0:
        return inner, inner
    nested = list(link_spans(inner))
    before = list(inner[: nested[-1][0]] if nested else "")
    for start, end in nested[:-1]:
        before[start:end] = " " * (end - start)
    begin = max(first, "".join(before).rfind("|"))
    return inner[:first].rstrip(), inner[begin + 1 :].strip()


def internal_links(text: str, options: Options) -> str:
    """[[title|..|label]]trail to label and trail, spaces of the label as underscores."""
    if not (spans := list(link_spans(text))):
        return text
    shown = [link_text(*link_parts(text[a + 2 : z - 2]), options).replace(" ", "_") for a, z in spans]
    trails = [TRAIL.match(text, z)[0] for _, z in spans]
    edges = [0, *(z + len(t) for (_, z), t in zip(spans, trails, strict=True))]
    kept = [text[a:z] for a, z in zip(edges, [*(a for a, _ in spans), len(text)], strict=True)]
    return kept[0] + "".join(s + t + k for s, t, k in zip(shown, trails, kept[1:], strict=True))


def quotes(text: str, html: bool) -> str:
    if "''" not in text and '""' not in text:
        return text
    if html:
        rules = [(r"'''''(.*?)'''''", r"<b>\1</b>"), (r"'''(.*?)'''", r"<b>\1</b>"), (r"''(.*?)''", r"<i>\1</i>")]
    else:
        rules = [
            (r"'''''(.*?)'''''", r"\1"), (r"'''(.*?)'''", r"\1"), (r"''\"([^\"]*?)\"''", r'"\1"'), (r"''(.*?)''", r'"\1"'),
            (r'""([^"]*?)""', r'"\1"'),
        ]
    for pattern, by in rules:
        text = re.sub(pattern, by, text)
    return text.replace("'''", "").replace("''", '"')


def placeholders(text: str) -> str:
    """Formulas and code to numbered words. Repeats get the number of the first, but count."""
    if "<" not in text:
        return text
    for tag, word in PLACEHOLDERS.items():
        found = re.finditer(rf"<\s*{tag}(?:\s*| [^>]+?)>.*?<\s*/\s*{tag}\s*>", text, re.S | re.I)
        for n, m in enumerate(list(found), 1):
            text = text.replace(m[0], f"{word}_{n}")
    return text


def tidy(text: str) -> str:
    text = text.replace("<<", "«").replace(">>", "»").replace("\t", " ")
    text = re.sub(r" {2,}", " ", text) if "  " in text else text
    text = re.sub(r"\.{4,}", "...", text) if "...." in text else text
    text = text.replace(" (,:.)]»)", "(,:.)]»)").replace("([(«) ", "([(«)")
    text = re.sub(r"\n\W+?\n", "\n", text) if "\n" in text else text
    return text.replace(",,", ",").replace(",.", ".")


def clean(text: str, options: Options, expander: Expander | None) -> str:
    """The page's markup removed, up to the pass over lines."""
    text = expander.expand(text) if expander else drop_nested(text, r"{{", r"}}")
    text = drop_nested(text, r"{\|", r"\|}") if "{|" in text else text
    text = internal_links(external_links(text, options), options)
    text = unescape_outside_highlight(SWITCH.sub("", text) if "__" in text else text)
    text = quotes(text, options.html)
    tags = DROPPED_TAGS if options.keep_links else [*DROPPED_TAGS, *LINK_TAGS]
    if "<" in text:
        names = tag_names(text)
        found = [COMMENT, *(p for t, p in tags if names is None or t in names)]
        text = cut(text, [m.span() for p in found for m in p.finditer(text)])
        names = tag_names(text)
        for tag, opening, closing in DISCARDED_TAGS:
            if (names is None or tag in names) and (left := drop_nested(text, opening, closing)) != text:
                text, names = left, tag_names(left)  # what stood around a region may be a tag together
    if not options.html:
        text = unescape(text)
    return tidy(placeholders(text))


class Lines:
    """The pass over lines: headers, lists, left-overs of tables, indented lines."""

    def __init__(self, options: Options) -> None:
        self.options, self.page = options, []
        self.headers: dict[int, str] = {}
        self.empty_section, self.stack = False, ""

    def titles(self) -> None:
        self.page += [self.headers[level] for level in sorted(self.headers)]

    def header(self, m: re.Match) -> None:
        level, title = len(m[1]), m[2]
        if self.options.html:
            self.page.append(f"<h{level}>{title}</h{level}>")
        ended = title if title[-1:] in ("", "!", "?") else title + "."
        self.headers = {k: v for k, v in self.headers.items() if k < level} | {level: ended}
        self.empty_section, self.stack = True, ""

    def item(self, line: str) -> None:
        """A line of a list: the lists that it doesn't go on are closed, those that it begins are opened."""
        marks, content = MARKED.match(line).groups()
        goes_on = [a == b or a in ";:" or b in ";:" for a, b in zip(self.stack, marks, strict=False)]
        ended = [m for i, m in enumerate(self.stack) if i >= len(marks) or not goes_on[i]]
        begun = [m for i, m in enumerate(marks) if i >= len(self.stack) or not goes_on[i]]
        self.lists(ended, "</{}>")
        self.lists(begun, "<{}>")
        self.stack = "".join(self.stack[i] if i < len(goes_on) and goes_on[i] else m for i, m in enumerate(marks))
        if not (content := content.strip()):
            return
        if self.options.lists:
            self.titles()
            self.headers = {}
            self.page.append(("1. " if marks[-1] == "#" else "- ").ljust(len(self.stack)) + content)
        elif self.options.html:
            tag = LIST_TAGS[marks[-1]][1]
            self.page.append(f"<{tag}>{content}</{tag}>")

    def lists(self, marks: list[str], tag: str) -> None:
        if self.options.html:
            self.page += [tag.format(LIST_TAGS[m][0]) for m in marks]

    def add(self, line: str) -> None:
        if m := HEADER.match(line):
            self.header(m)
        elif line.startswith("++"):
            if title := line[2:-2]:
                self.page.append(title if title[-1] in "!?" else title + ".")
        elif line[0] == ":":
            return
        elif line[0] in LIST_MARKS:
            self.item(line)
        elif self.stack:
            self.page.append(line)
            self.lists(list(reversed(self.stack)), "</{}>")
            self.stack = ""
        elif line[0] in "{|" or line[-1] == "}" or (line[0] == "(" and line[-1] == ")") or not line.strip(".-"):
            return
        elif self.headers:
            if self.options.sections:
                self.titles()
            self.headers, self.empty_section = {}, False
            self.page.append(line)
        elif not self.empty_section and line[0] != " ":
            self.page.append(line)


def compact(text: str, options: Options) -> list[str]:
    lines = Lines(options)
    for line in text.split("\n"):
        if line:
            lines.add(line)
    return lines.page


def left_links(text: str) -> str:
    """[[..]] that is still there: away if it has a colon, else what stands before its first bar."""
    text = re.sub(r"\[\[(?=[^\]]*:)[^\]]*\]\]", "", text)
    return re.sub(r"\[\[([^\]|]*)[^\]]*\]\]", lambda m: m[1].replace("[[", ""), text)


def numbers(text: str) -> str:
    """Commas out of grouped numbers, those at the edges of the match included."""
    return re.sub(r"[^\d]\d{1,2}(?:,\d{3})+[^\d]", lambda m: m[0].replace(",", ""), text)


#: Templates that show one of their parts, by name or its beginning.
SHOWN = ((re.compile(r"(?:link|lang)-.*|IPA|le", re.S), 1), (re.compile("link|lang"), 2))


def left_templates(text: str) -> str:
    """Lines with {{..}} that is still there, until none is left: the content of language templates, else nothing. Each
    round takes braces away, so there is a last one."""

    def shown(line: re.Match) -> str:
        parts = re.sub(r"\{\{|\}\}", "", line[0]).split("|")
        return next((parts[n] for names, n in SHOWN if names.fullmatch(parts[0])), "")

    found = 1
    while found:
        text, found = re.subn(r".*\{\{[^{}]*\}\}.*", shown, text)
    return text


def strip_tags(text: str) -> str:
    return re.sub(r"<[^>]*>", "", text)


def middle_dots(text: str) -> str:
    return re.sub("[．‧˙]", "·", text)


def finish(lines: list[str]) -> str:
    """The last steps, over the joined lines."""
    text = "".join(f"{x}\n" for x in lines)
    text = middle_dots(strip_tags(text) if "<" in text else text)
    text = left_links(text) if "[[" in text else text
    text = numbers(text) if "," in text else text
    text = left_templates(text) if "{{" in text else text
    return LATE_SWITCH.sub("", text) if "__" in text else text


def plain_text(text: str, options: Options, expander: Expander | None) -> str:
    return finish(compact(clean(text, options, expander), options))
