"""Text functions as column expressions: no function here leaves the JVM, except the two Arrow ones at the end."""

from __future__ import annotations

import html as _html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

#: White space that Python's str.strip removes, as a Java class.
WHITE = "\\s\\x1c-\\x1f\\x85\\p{Z}"
#: Stems of month names, menu tokens and rubric names of the journal's pages.
MONTHS = "январ|феврал|март|апрел|май|июн|июл|август|сентябр|октябр|ноябр|декабр"
MENU = ("выпуски", "/", "←", "→")
TITLE_SKIP = ("выпуски", "←", "→", "&larr;", "&rarr;")
RUBRICS = ("Обзоры актуальных проблем", "Конференции и симпозиумы", "От редакционной коллегии", "История физики", "Методы исследования", "Перспективные проблемы")
UNTITLED = "Без названия"
#: Entities that the expression form of unescape knows, in order of replacement (`&amp;` last).
ENTITIES = (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&laquo;", "«"), ("&raquo;", "»"), ("&mdash;", "—"), ("&ndash;", "–"), ("&larr;", "←"), ("&rarr;", "→"), ("&amp;", "&"))
#: The steps of markup removal, pattern and replacement, before and after unescaping.
MARKUP = (
    ("(?is)<!--.*?-->", " "),
    ("(?is)<script[^>]*>.*?</script>", " "),
    ("(?is)<style[^>]*>.*?</style>", " "),
    ("(?i)<br\\s*/?>", "\n"),
    ("</(?:p|motion|div|li|h[0-9]|tr)>", "\n"),
    ("<[^>]+>", " "),
)
BLANKS = ((" ", " "), ("[ \\t]+", " "), ("\\n{3,}", "\n\n"))


def let(value: Column, use) -> Column:
    """`use(value)`, with `value` computed once however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WHITE}]+|[{WHITE}]+\\z", "")


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def _code_points(c: Column) -> Column:
    """Numeric entities, decimal and hexadecimal, as characters; what is no character as U+FFFD."""

    def piece(p: Column) -> Column:
        number = F.coalesce(F.nullif(F.regexp_extract(p, "^#0*([0-9]{1,7});", 1), F.lit("")), F.conv(F.nullif(F.regexp_extract(p, "^#[xX]0*([0-9a-fA-F]{1,6});", 1), F.lit("")), 16, 10)).cast("int")
        good = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(good, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(number.isNotNull(), F.concat(char, F.regexp_replace(p, "^#[0-9a-zA-Z]+;", ""))).otherwise(F.concat(F.lit("&"), p))

    def read(text: Column) -> Column:
        parts = F.split(text, "&", -1)
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))

    return let(c, lambda text: F.when(F.contains(text, F.lit("&#")), read(text)).otherwise(text))


def unescape_listed(c: Column) -> Column:
    """Numeric entities and the named ones of ENTITIES; `unescape` knows all of them."""
    for entity, char in ENTITIES[:-1]:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.replace(_code_points(c), F.lit(ENTITIES[-1][0]), F.lit(ENTITIES[-1][1]))


def _steps(c: Column, steps) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def html_to_text(c: Column, unescape=unescape_listed) -> Column:
    """Markup to lines of text; no blank line survives."""
    plain = _steps(unescape(_steps(c, MARKUP)), BLANKS)
    return F.array_join(F.filter(F.transform(lines(plain), strip), lambda x: x != ""), "\n")


def normalize_whitespace(c: Column) -> Column:
    return F.regexp_replace(strip(c), "\n{3,}", "\n\n")


def clean_page_lines(c: Column) -> Column:
    """Drops lines that hold nothing but one to four digits."""
    return normalize_whitespace(F.array_join(F.filter(lines(c), lambda x: ~strip(x).rlike("^[0-9]{1,4}\\z")), "\n"))


def drop_nav_prefix(c: Column) -> Column:
    """Drops mail lines, then all up to the first line that reads like text; unchanged if nothing is left."""
    low = lambda x: F.lower(strip(x))
    starts = lambda x: (F.length(x) > 25) & ~low(x).isin(*MENU) & ~x.rlike("^[0-9]{4}\\z") & ~low(x).rlike(f"^(?:{MONTHS})") & ~x.rlike("^[\\s/←→0-9]+\\z")

    def body(text: Column) -> Column:
        kept = F.filter(lines(text), lambda x: ~x.rlike("@|mail[0-9]|Ud%|-->|\\$"))
        placed = let(kept, lambda k: F.struct(k.alias("k"), F.array_position(F.transform(k, starts), True).cast("int").alias("at")))
        return let(placed, lambda p: F.when(p["at"] > 0, F.array_join(F.slice(p["k"], p["at"], F.size(p["k"])), "\n")).otherwise(text))

    return let(c, body)


def extract_title(plain: Column, markup: Column) -> Column:
    good = F.filter(lines(plain), lambda x: ~F.lower(x).isin(*TITLE_SKIP) & ~x.rlike("^[0-9]{4}\\z") & (F.length(x) >= 12) & ~F.lower(x).rlike(f"^(?:{MONTHS})"))
    bold = F.regexp_extract(markup, "<b>([^<]{10,300})</b>", 1)
    return F.coalesce(F.substring(F.try_element_at(good, F.lit(1)), 1, 500), F.nullif(strip(unescape_listed(bold)), F.lit("")), F.lit(UNTITLED))


def extract_section(markup: Column) -> Column:
    return F.nullif(F.regexp_extract(markup, f"(?iu)({'|'.join(RUBRICS)})", 1), F.lit(""))


def extract_authors(markup: Column) -> Column:
    head = F.substring(markup, 1, 8000)
    word = "[А-ЯЁ][а-яё]+"
    tidy = lambda a: F.array_distinct(F.transform(a, lambda x: unescape_listed(strip(x))))
    full = F.regexp_extract_all(head, F.lit(f"(?U)<b>({word}\\s+[А-ЯЁ]\\.\\s*[А-ЯЁ]\\.\\s+{word})</b>"), F.lit(1))
    pair = F.regexp_extract_all(head, F.lit(f"(?U)<b>({word}\\s+{word})</b>"), F.lit(1))
    return F.when(F.size(full) > 0, tidy(full)).otherwise(tidy(F.slice(pair, 1, 8)))


def script_ratio(c: Column, low: str = "\\u0400", high: str = "\\u04FF") -> Column:
    """Share of letters within a script range; 0 without letters."""
    # the range is counted among the letters only, which are taken out once
    letters = F.regexp_replace(c, "\\P{L}+", "")
    return let(letters, lambda x: F.coalesce(F.try_divide(F.length(F.regexp_replace(x, f"[^{low}-{high}]+", "")).cast("double"), F.length(x)), F.lit(0.0)))


def is_readable(c: Column, low: str = "\\u0400", high: str = "\\u04FF", min_chars: int = 200, min_ratio: float = 0.12, ratio: Column | None = None) -> Column:
    """Whether a text is long enough and has enough letters of a script; `ratio` if it is known already."""
    return (F.length(strip(c)) >= min_chars) & ((script_ratio(c, low, high) if ratio is None else ratio) >= min_ratio)


def file_name(url: Column) -> Column:
    name = F.element_at(F.split(F.regexp_replace(url, "/+\\z", ""), "/"), -1)
    return F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))


def host(url: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")), url)


def resolve_url(path: Column, base: str) -> Column:
    return F.when(path.rlike("^https?://"), path).otherwise(F.concat(F.lit(base), path))


def article_pdf_url(path: Column, parity: bool = False) -> Column:
    """The article's file address; with `parity` the known defect is kept: always null."""
    if parity:
        return F.lit(None).cast("string")
    part = lambda k: F.regexp_extract(path, "^/?ru/articles/([0-9]{4})/([0-9]+)/([a-z])/?", k)
    yy = F.substring(part(1), 3, 2)
    url = F.concat(F.lit("https://ufn.ru/ufn"), yy, F.lit("/ufn"), yy, F.lit("_"), part(2).try_cast("int").cast("string"), F.lit("/Russian/r"), yy, part(2).try_cast("int").cast("string"), part(3), F.lit(".pdf"))
    return F.when(part(1) != "", url)


#: Addresses of the journal's pages and files, by year, volume, letter and page.
TEMPLATES = {
    "volume": "https://ufn.ru/ru/articles/%d/%d/",
    "article": "https://ufn.ru/ru/articles/%d/%d/%s/",
    "pdf": "https://ufn.ru/ufn%02d/ufn%02d_%d/Russian/r%02d%d%s.pdf",
    "name": "%d_%d_%s.pdf",
}


def from_template(kind: str, year: Column, volume: Column, letter: Column) -> Column:
    yy = year % 100
    args = {"volume": (year, volume), "article": (year, volume, letter), "pdf": (yy, yy, volume, yy, volume, letter), "name": (year, volume, letter)}[kind]
    return F.format_string(TEMPLATES[kind], *args)


def remove_soft(c: Column) -> Column:
    """Without no-break spaces and soft hyphens."""
    return F.translate(c, "\u00a0\u00ad", "")


def normalize_text(c: Column) -> Column:
    """One kind of line break, no hyphen at a line's end within a word, single blanks, at most one blank line in a row."""
    breaks = F.regexp_replace(c, "\r\n?|[\u2028\u2029\f\u0085]", "\n")
    whole = F.regexp_replace(remove_soft(F.replace(breaks, F.lit("\u00ad\n"), F.lit(""))), "([\\p{L}])-\n([\\p{Ll}])", "$1$2")
    blanks = F.regexp_replace(whole, "[ \t]+", " ")
    return normalize_whitespace(F.regexp_replace(blanks, " ?\n ?", "\n"))


#: What tells a label, and goes: codes with the name of their scheme, fields and paths of a catalogue.
LEAKS = (
    r"(?iu)\b(?:ГРНТИ|УДК|UDC|PACS|PhySH|GRNTI)\b\s*:?\s*(?:[0-9]{2}[0-9.:+/()a-z-]*(?:\s*[,;]\s*[0-9]{2}[0-9.:+/()a-z-]*)*)?",
    r"(?imu)^\s*(?:category|subject|section|рубрика|раздел|категория)\s*[:=][^\n]*\n?",
    r"(?mu)^[^\n>»/]{1,60}(?:\s[>»]\s[^\n>»]{1,60}){2,}$\n?",
)
LEFT_CODE = r"(?iu)\b29\.[0-9]{2}(?:\.[0-9]{2})?\b|\b(?:ГРНТИ|УДК|PACS|PhySH)\b"


def scrub_labels(c: Column) -> Column:
    """Without codes of classifiers, fields and trails of a catalogue; the author's words stay."""
    for pattern in LEAKS:
        c = F.regexp_replace(c, pattern, " ")
    return normalize_whitespace(F.regexp_replace(F.regexp_replace(c, "[ \t]+", " "), " ?\n ?", "\n"))


def leaks_label(c: Column) -> Column:
    """Whether a code or the name of a classifier is still there."""
    return F.coalesce(c.rlike(LEFT_CODE), F.lit(False))


def mask_spans(c: Column, spans: Column, mask: str = "[FORMULA]") -> Column:
    """`c` with every span (array of struct<start, end>, from 0, in characters) as one mask; spans that overlap or touch nothing are merged or skipped."""
    ordered = F.array_sort(F.filter(spans, lambda s: s["end"] > s["start"]))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(c, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"].cast("long")).alias("at"), F.when(fresh, F.concat(acc["out"], gap, F.lit(mask))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(ordered, begin, step, lambda acc: F.concat(acc["out"], F.substring(c, (acc["at"] + 1).cast("int"), F.length(c))))


def length_metrics(c: Column) -> Column:
    """Struct of characters and words; subtokens need a tokenizer, see `subtokens`."""
    words = F.filter(F.split(strip(c), f"[{WHITE}]+"), lambda w: w != "")
    return F.struct(F.length(c).cast("long").alias("characters"), F.size(words).cast("long").alias("words"))


def code_links(markup: Column) -> Column:
    """Codes with their names, from links whose text has a digit: array of struct<code, name>, sorted, each once."""
    link = F.lit('(?is)<a[^>]*title="([^"]*)"[^>]*>([^<]*[0-9][^<]*)</a>')
    both = F.arrays_zip(F.regexp_extract_all(markup, link, F.lit(2)).alias("code"), F.regexp_extract_all(markup, link, F.lit(1)).alias("name"))
    return F.array_sort(F.array_distinct(F.transform(both, lambda x: F.struct(strip(x["code"]).alias("code"), F.lower(strip(x["name"])).alias("name")))))


def perplexity_ratio(delta: Column) -> Column:
    """Relative change of perplexity that a mean difference of losses means."""
    return F.exp(delta) - 1


def paired(rows: DataFrame, key: str, model: str, value: str, first: str, second: str, *keep: str) -> DataFrame:
    """(key, keep, delta): value of the first model minus that of the second, for keys that have both; one grouped pass replaces the join."""
    of = lambda m: F.avg(F.when(F.col(model) == m, F.col(value)))
    return rows.groupBy(key, *keep).agg((of(first) - of(second)).alias("delta")).where("delta is not null")


def period(year: Column) -> Column:
    """The two periods."""
    return F.when(year.between(2000, 2012), "2000-2012").when(year.between(2013, 2025), "2013-2025")


def normalize_doi(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.lower(strip(c)), "^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)|[?#].*\\z", ""), F.lit(""))


def grnti_class(code: Column) -> Column:
    """Level-two code to class. The five codes."""
    two = F.regexp_extract(code, "^([0-9]{2}\\.[0-9]{2})", 1)
    table = F.create_map(*(F.lit(x) for pair in (("29.05", "C1"), ("29.15", "C2"), ("29.19", "C3"), ("29.27", "C4"), ("29.33", "C5")) for x in pair))
    return table[two]


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the values alone, never on the partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def softmax(a: Column) -> Column:
    grown = F.transform(a, lambda x: F.exp(x.cast("double") - F.array_max(a)))
    return F.transform(grown, lambda x: x / F.aggregate(grown, F.lit(0.0), lambda s, y: s + y))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(_html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def decode_text(content: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes in a charset as text (UTF-8 where it is null); bytes that don't fit are replaced."""
    return pd.Series([None if b is None else bytes(b).decode(c or "utf-8", "replace") for b, c in zip(content, charset, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def h2_input(title: Column, abstract: Column) -> Column:
    """What the classifier reads: title and abstract in NFC, a blank line between them, a line break at the end."""
    return F.concat(nfc(title), F.lit("\n\n"), F.coalesce(nfc(abstract), F.lit("")), F.lit("\n"))


def h2_input_sha256(title: Column, abstract: Column) -> Column:
    return F.sha2(h2_input(title, abstract), 256)


@F.pandas_udf(LongType())
def word_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance in words."""

    def edits(x: str | None, y: str | None) -> int | None:
        if x is None or y is None:
            return None
        u, v = x.split(), y.split()
        row = list(range(len(v) + 1))
        for i, p in enumerate(u, 1):
            left, row[0] = row[0], i
            for j, q in enumerate(v, 1):
                left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (p != q))
        return row[-1]

    return pd.Series([edits(x, y) for x, y in zip(a, b, strict=True)], dtype="Int64")
