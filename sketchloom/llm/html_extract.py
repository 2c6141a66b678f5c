"""HTML extraction: two passes of block rules over stop-word density, length and link density."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# Common words of English, French, German, Spanish, Italian, Portuguese, Dutch and Russian.
STOP_WORDS = frozenset(
    "the of and a to in is that it for was on are as with be at by this from or an had not but have they which "
    "de la le et les des en un une du que qui dans est pour pas sur par au avec "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an "
    "el los las y se del por con una su para al lo como más "
    "il di che è e non per sono della nel gli o não uma os ao em "
    "het een dat van ik niet zijn op и в не на что с по".split()
)
# Common characters of Chinese and Japanese, which are written without spaces.
STOP_CHARACTERS = frozenset("的是了在和有不这我他也就の は を が に で と も た し".replace(" ", ""))
# Elements whose content is never text, and those that only mark up a run of text.
SILENT = "script style title noscript template textarea select button svg math iframe object canvas video audio".split()
#: Those of SILENT that hold no raw text: a start tag that ends in /> has no content.
CLOSABLE = "template select button svg math object canvas video audio".split()
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br input".split())
#: Elements that hold other blocks; those of FRAME are never part of an article.
HOLDERS = frozenset("article main section div nav aside footer header form ul ol dl table figure blockquote details dialog fieldset menu".split())
FRAME = frozenset("nav aside footer form menu dialog".split())
# Words in class, id or role that mark frames, notices, adverts and reader comments.
FRAME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal overlay comment "
    "comments disqus respond replies share sharing social related recommended newsletter subscribe signup login search "
    "pagination pager toolbar widget copyright contentinfo complementary".split()
)
# Those of FRAME_WORDS that articles use too, and elements that can't hold other elements or text.
WEAK_WORDS = frozenset("sponsor sponsored promo promotion notice notices respond replies share sharing social related recommended signup login search toolbar widget copyright".split())
VOID = frozenset("area base col embed hr link meta param source track".split())
LINES = frozenset("p li h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"""|<(?:{'|'.join(CLOSABLE)})(?=[\s/])(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<=/)>"""
    rf"|<(?P<silent>{'|'.join(SILENT)})(?=[\s/>])[^>]*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|</?(?P<tag2>[a-z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/a-z][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORD = re.compile(r"[^\W\d_]+")
UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    framed: bool = False
    inside: bool = False
    text: str = ""
    mark: int = -1  # the innermost element around it that may be a frame


@dataclass
class Mark:
    """An element that is a frame by a part of its class or by a weak word, with the text that it holds."""

    around: int
    weak: bool
    size: int = 0
    linked: int = 0
    framed: bool = False


def is_frame(tag: str, attrs: str, inside: bool, held: bool = True) -> str:
    """How an element's name and attributes make it a menu, notice, advert, comment or the like.

    "frame" where they do; "doubt" where only a part of a class or id does, or only weak words; "weak"
    for a part that is a weak word; "" where nothing does. A part of a paragraph's class counts only if
    it is no weak word; for an article or main element in no article (held is false) a class or id
    never counts.
    """
    found = ""
    if tag in FRAME or (tag == "header" and not inside):
        return "frame"
    for name, value in ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "frame"
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "frame"
        if name in ("class", "id", "role"):
            if value == "header" and not inside:
                return "frame"
            words = set(re.split(r"[\s_\-]+", value)) - {""}
            framing = FRAME_WORDS & words
            if not framing or (not held and name != "role" and tag in ("article", "main")):
                continue
            strong = not framing <= WEAK_WORDS
            if name == "role" or (words <= FRAME_WORDS and (strong or tag in LINES)):
                return "frame"
            if strong or words <= FRAME_WORDS:
                found = "doubt"
            elif tag not in LINES:
                found = found or "weak"
    return found


def blocks_of(page: str, most_linked: float = 0.2) -> list[Block]:
    """The text blocks of a page in order, with their links and the elements around them.

    An element in doubt is a frame unless it holds more than half of the page's text; one with a
    weak word is a frame if more than `most_linked` of its text is linked.
    """
    out: list[Block] = []
    block = Block()
    stack: list[tuple[str, bool, bool, int]] = []  # element, framed, inside an article, mark
    places: defaultdict[str, list[int]] = defaultdict(list)  # of each element's name in the stack
    marks: list[Mark] = []
    depth, link, breaks, at = 0, None, 0, 0

    def add(raw: str) -> None:
        nonlocal breaks
        if raw and not raw.isspace():
            breaks = 0
            if link is not None:
                block.linked += len(html.unescape(raw).strip())
        block.parts.append(raw)

    def close() -> None:
        nonlocal block, breaks
        text = " ".join(html.unescape("".join(block.parts)).split())
        if text:
            block.text = text
            out.append(block)
        _, framed, inside, mark = stack[-1] if stack else ("", False, False, -1)
        block, breaks = Block(framed=framed, inside=inside, mark=mark), 0

    def cut(place: int) -> None:
        while len(stack) > place:
            places[stack.pop()[0]].pop()

    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        ends = m[0].startswith("</")
        if tag == "a":
            link = None if ends else depth
        if tag == "br":
            breaks += 1
            if breaks > 1:
                close()
            else:
                block.parts.append(" ")
        if tag in INLINE:
            continue
        close()
        attrs = m["attrs"] or m["attrs2"] or ""
        if ends:
            depth = max(0, depth - 1)
            if link is not None and depth < link:
                link = None  # a link that was left open ends with the element around it
            if places[tag]:
                cut(places[tag][-1])
        elif stack and stack[-1][0] in LINES:
            cut(len(stack) - 1)  # a paragraph with a mark of its own ends where the next block begins
        if not ends and not attrs.endswith("/") and tag not in VOID:
            depth += 1
            _, framed, inside, mark = stack[-1] if stack else ("", False, False, -1)
            frame = is_frame(tag, attrs, inside, bool(places["article"]))
            if frame in ("doubt", "weak"):
                marks.append(Mark(mark, frame == "weak"))
                mark = len(marks) - 1
            if tag in HOLDERS or (frame and tag in LINES):
                places[tag].append(len(stack))
                stack.append((tag, framed or frame == "frame", inside or tag in ("article", "main") or bool(re.search(r"role\s*=\s*[\"']?main", attrs)), mark))
        _, block.framed, block.inside, block.mark = stack[-1] if stack else ("", False, False, -1)
    add(page[at:])
    close()
    total = 0
    for b in out:
        total += len(b.text)
        if b.mark >= 0:
            marks[b.mark].size += len(b.text)
            marks[b.mark].linked += b.linked
    for x in reversed(marks):  # an element comes after the one around it
        if x.around >= 0:
            marks[x.around].size += x.size
            marks[x.around].linked += x.linked
    for x in marks:
        own = x.linked > most_linked * x.size if x.weak else 2 * x.size <= total
        x.framed = own or (x.around >= 0 and marks[x.around].framed)
    for b in out:
        b.framed = b.framed or (b.mark >= 0 and marks[b.mark].framed)
    return out


def measures(text: str) -> tuple[int, int, int]:
    """Length, words and stop words of a text; a character of a script without spaces counts as a word and twice."""
    text = text.lower()
    unspaced = UNSPACED.findall(text)
    words = WORD.findall(UNSPACED.sub(" ", text) if unspaced else text)
    stops = sum(w in STOP_WORDS for w in words) + sum(c in STOP_CHARACTERS for c in unspaced)
    return len(text) + len(unspaced), len(words) + len(unspaced), stops


def main_text(
    page: str,
    short: int = 70,
    long: int = 200,
    stops_low: float = 0.1,
    stops_high: float = 0.2,
    most_linked: float = 0.4,
    least_known: float = 0.02,
) -> str:
    """The blocks of a page's article, joined by empty lines.

    First pass: frames and blocks of links are out. Long blocks with many stop words and blocks of
    medium length with some are in; those with fewer and short blocks are undecided. Where fewer than `least_known` of the page's words are stop words, its
    language is not known here and length decides alone: long blocks are in, others undecided. Where a
    page has an article or main element, its mark-up speaks too: blocks outside it are out, and those
    in it that are not linked are in or, with few stop words, undecided.

    Second pass: a short undecided block takes the label of its nearest decided neighbour that is no frame; a
    longer one is in if no decided neighbour is out, and so are all where nothing is decided. In an article
    a block is out only if both neighbours are and are in the article.
    """
    blocks = blocks_of(page)
    marked = any(b.inside and not b.framed for b in blocks)
    sizes = [measures(b.text) for b in blocks]
    told = [x for b, x in zip(blocks, sizes, strict=True) if not b.framed]
    known = sum(x[2] for x in told) >= least_known * sum(x[1] for x in told)
    labels: list[bool | None] = []
    for b, (n, words, stops) in zip(blocks, sizes, strict=True):
        share = stops / words if words else 0.0
        if b.framed or (marked and not b.inside) or b.linked > most_linked * len(b.text):
            labels.append(False)
        elif n < short:
            labels.append(None)
        elif not known:
            labels.append(True if n >= long or marked else None)
        elif share >= (stops_high if n >= long and not marked else stops_low):
            labels.append(True)
        else:
            labels.append(None)
    kept = []
    # where a page is not marked, a frame says nothing of the blocks around it
    decided = [(i, x) for i, x in enumerate(labels) if x is not None and (marked or not blocks[i].framed)]
    upto = 0
    for i, b in enumerate(blocks):
        label = labels[i]
        while upto < len(decided) and decided[upto][0] < i:
            upto += 1
        if label is None:
            near = decided[max(0, upto - 1) : upto] + decided[upto : upto + 1]
            if b.inside:
                label = len(near) < 2 or any(x[1] for x in near) or all(blocks[x[0]].framed or not blocks[x[0]].inside for x in near)
            elif len(near) == 2 and i - near[0][0] == near[1][0] - i:
                label = near[0][1] and near[1][1]
            else:
                label = min(near, key=lambda x: abs(x[0] - i))[1] if near and sizes[i][0] < short else all(x[1] for x in near)
        if label:
            kept.append(b.text)
    return "\n\n".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages.

    Null, empty and textless html give an empty text. Unclosed elements, comments and tags cut off
    at the end of the page are markup. Repeated rows are extracted one by one; an empty table gives
    no rows; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) if x else "" for x in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
