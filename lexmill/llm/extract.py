"""Main text of HTML pages by two-pass block rules.

Pass one cuts a page into blocks at block-level tags and classes each by length,
stop-word density and link density; blocks within page furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are out at once.
Short blocks with few stop words are ambiguous.  Pass two gives every ambiguous
block the label of its nearest decided neighbours: of both sides if they agree,
else of the side that lies in the same container, else out.  On a page without any
decided block the ambiguous ones are the text.

Where a page marks its article (`article`, `main` or role=main), that is a prior, not a verdict: a
block inside needs one of length and stop words, is never out for its links (an author's
paragraph may be one), and blocks outside are out.  The mark is set aside where the text
outside it that passes by the rules alone is FRAME_ODDS times as long, as on a page of teasers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import sliced, texts_of

#: Tags that begin and end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is never text.
RAW_TAGS = frozenset("script style noscript template svg math iframe object embed canvas audio video select textarea option head title button".split())
#: Elements that are page furniture.
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark page furniture, on any element and on containers only.
FURNITURE = "ad|ads|advert\\w*|banner|sponsor\\w*|promo\\w*|menu|nav\\w*|breadcrumbs?|cookies?|consent|gdpr|popup|modal|newsletter|subscri\\w*|share|sharing|social|comments?|replies|disqus|pagination|pager|contentinfo|complementary|navigation"
CONTAINER_ONLY = "sidebar|side|footer|header|masthead|notice|alert|overlay|signup|login|related|recommend\\w*|respond|toolbar|widget|copyright|legal|search|tags?|meta"
FURNITURE_WORDS = re.compile(rf"(?:^|[\s_-])(?:{FURNITURE}|{CONTAINER_ONLY})(?:$|[\s_-])", re.I)
LINE_WORDS = re.compile(rf"(?:^|[\s_-])(?:{FURNITURE})(?:$|[\s_-])", re.I)
#: Elements that hold a line or a part of one, and classes of an article that isn't the page's.
LINE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption span a b i em strong u s small sub sup code q cite abbr time mark td th dt dd".split())
OTHER_ARTICLES = frozenset("comment comments reply replies respond ad ads advert advertisement promo sponsored teaser related".split())
#: Frequent function words of the languages covered.
STOP_WORDS = frozenset(
    (
        "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over me even most made after also did many before must through back years where much your way well down should because each just those people how too "
        "der die das und in zu den von ist mit des im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei ich du wir ihr "
        "le la les de des du un une et à en que qui dans pour par sur pas au aux il elle est ce se ne plus son sa ses avec sont ou mais comme on nous vous ils cette été être leur y deux même tout fait "
        "el los las de del y que en un una por con para es no se su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos "
        "и в не на я быть он с что а по это она к но они мы весь от за из у так же вы для как или бы "
    ).split()
)
MAX_LINK_DENSITY = 0.5
LONG, SHORT = 140, 60
HIGH_STOPS, LOW_STOPS = 0.30, 0.15
FRAME_ODDS = 3

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_WORD = re.compile(r"\w+")
_BARE_SLASH = re.compile(r"=\s*[^\s\"'=]+/$")  # the slash belongs to a value without quotes
#: Elements that a new one of the same kind closes, and the ones that close an open paragraph.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def attributes_of(source: str) -> dict[str, str]:
    """Attributes by name in lower case; of a name that is there twice the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def furnishes(tag: str, marks: dict[str, str], article: bool) -> bool:
    """Whether an element is page furniture; article: it lies within a marked article."""
    if tag in FURNITURE_TAGS and not (tag == "header" and article):
        return True
    if "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(marks.get("style", "")):
        return True
    names = " ".join(marks[k] for k in ("class", "id", "role") if marks.get(k))
    if not names or tag in ("html", "body", "main"):
        return False
    if tag == "article" or marks.get("role", "").lower() == "main":
        return not OTHER_ARTICLES.isdisjoint(names.lower().split())
    return bool((LINE_WORDS if tag in LINE_TAGS else FURNITURE_WORDS).search(names))


class Block:
    __slots__ = ("text", "links", "out", "inside", "holder", "label")

    def __init__(self, text: str, links: int, out: bool, inside: bool, holder: int):
        self.text, self.links, self.out, self.inside, self.holder = text, links, out, inside, holder
        self.label = ""


def blocks_of(html: str) -> list[Block]:
    """Blocks of visible text in page order."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, int, bool]] = []  # tag, furniture, article, number, within a link
    parts: list[str] = []
    linked = 0
    in_link = False
    number = 0
    at = 0
    furniture = article = False

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(linked, len(text)), furniture, article, next((s[3] for s in reversed(stack) if s[0] not in ("p", "b", "i", "a", "span", "li", "br")), 0)))
        parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if in_link:
                linked += len(" ".join(piece.split()))

    n = len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        m = _TOKEN.match(html, lt)
        if not m:
            text(html[at : lt + 1])
            at = lt + 1
            continue
        text(html[at:lt])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):  # an end tag
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    furniture, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                    in_link = bool(stack) and stack[-1][4]
                    break
            continue
        attributes = m.group(3) or ""
        if tag in RAW_TAGS and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?:[\s/>]|\Z)", re.I).search(html, at)
            parts.append(" ")
            if end:
                close = html.find(">", end.start())
                at = n if close < 0 else close + 1
            elif tag in ("head", "title", "button", "option", "select", "object"):
                continue
            else:
                at = n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if tag in VOID_TAGS:
            continue
        if tag == "a" or tag in BLOCK_TAGS:  # a new anchor ends an open one, a new block the paragraph around one
            k = len(stack) - 1
            while k >= 0 and stack[k][0] != "a" and stack[k][0] not in BLOCK_TAGS:
                k -= 1
            if k >= 0 and stack[k][0] == "a":
                outer = next((j for j in range(k - 1, -1, -1) if stack[j][0] in BLOCK_TAGS), -1)
                if tag == "a":
                    del stack[k:]
                elif outer >= 0 and stack[outer][0] == "p":
                    del stack[outer:]
        if tag in BLOCK_TAGS and tag != "p" and stack and stack[-1][0] == "p" or tag == "p" and stack and stack[-1][0] == "p":
            stack.pop()
        while tag in _CLOSES and stack and stack[-1][0] in _CLOSES[tag]:
            stack.pop()
        in_link = bool(stack) and stack[-1][4]
        if not attributes.endswith("/") or tag == "a" and _BARE_SLASH.search(attributes):
            furniture, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            marks = attributes_of(attributes) if attributes else {}
            frame = tag in ("article", "main") or marks.get("role", "").lower() == "main"
            part = furnishes(tag, marks, article)
            number += 1
            furniture, article = furniture or part, (article or frame) and not part
            in_link = in_link or tag == "a" and "href" in marks
            stack.append((tag, furniture, article, number, in_link))
    flush()
    return out


def _stops(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _rated(b: Block, inside: bool) -> str:
    """Pass one for one block that is no furniture: good, bad or ambiguous ('')."""
    size, density = len(b.text), b.links / len(b.text)
    if density > MAX_LINK_DENSITY:
        return "" if inside else "bad"
    stops = _stops(b.text)
    if inside:
        return "good" if size >= SHORT or stops >= LOW_STOPS else ""
    if size >= LONG:
        return "good" if stops >= LOW_STOPS or density < 0.1 else ""
    return "good" if size >= SHORT and stops >= HIGH_STOPS else ""


def classify(blocks: list[Block]) -> bool:
    """Pass one over all blocks; returns whether the marked article holds."""
    for b in blocks:
        b.label = "bad" if b.out else _rated(b, b.inside)
    within = sum(len(b.text) for b in blocks if b.inside and not b.out)
    outside = sum(len(b.text) for b in blocks if not b.inside and b.label == "good")
    framed = within > 0 and outside < FRAME_ODDS * within
    for b in blocks:
        if framed and not b.inside:
            b.label = "bad"
        elif not framed and b.inside and not b.out:
            b.label = _rated(b, False)
    return framed


def inherit(blocks: list[Block], framed: bool) -> None:
    """Pass two: ambiguous blocks take the label of their nearest decided neighbours."""
    heard = [k for k, b in enumerate(blocks) if b.label and not b.out and (b.inside or not framed)]
    nothing = not any(blocks[k].label == "good" for k in heard)
    decided = []
    at = 0
    for k, b in enumerate(blocks):
        while at < len(heard) and heard[at] < k:
            at += 1
        if b.label:
            continue
        near = [blocks[j] for j in (*heard[max(0, at - 1) : at], *heard[at : at + 1])]
        labels = {x.label for x in near}
        if nothing:
            label = "good" if framed or b.links / len(b.text) <= MAX_LINK_DENSITY else "bad"
        elif len(labels) == 1:
            label = labels.pop()
        else:
            same = [x.label for x in near if x.holder == b.holder]
            label = "good" if same == ["good"] or "good" in same and len(same) == 2 and len(b.text) >= SHORT else "bad"
        decided.append((b, label))
    for b, label in decided:
        b.label = label


def main_text(html: str) -> str:
    """Good blocks, joined by one newline each; empty if none."""
    blocks = blocks_of(html)
    inherit(blocks, classify(blocks))
    return "\n".join(b.text for b in blocks if b.label == "good")


def _extract(batches, column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, column):
            out = [main_text(h.decode("utf-8", "replace")) for h in texts_of(part, column)]
            keep = [part.column(k) for k in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=[*part.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, one row per input row.

    pages: page_id, url, html; further columns are ignored.  Null or empty html
    gives an empty text; very long pages are read whole.  Broken markup is read as far as it goes: an unclosed
    comment or script runs to the end, other unclosed elements are closed by
    their parents.  Repeated rows give equal rows; an empty table none.
    """
    data = pages.select("page_id", "url", pages["html"].cast("string").alias("html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-1])
    return data.mapInArrow(partial(_extract, column="html"), f"{schema}, text string, n_chars long")
