"""Text functions, Column to Column. White space is Unicode white space throughout, as `trim` alone strips only spaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no topic.
STOPWORDS = (
    "the", "and", "for", "with", "that", "this", "from", "into", "via", "using",
    "use", "uses", "used", "are", "was", "were", "been", "being", "can", "may",
    "has", "have", "had", "not", "but", "its", "their", "our", "your", "you",
    "study", "studies", "paper", "research", "results", "show", "shows", "new",
    "based", "through", "between", "within", "across", "during", "reveals",
    "revealed", "revealing", "suggests", "provides", "demonstrates", "toward",
)
# Accented letters and what they are compared as.
ACCENTED, PLAIN = "áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc"
# Marks after which a preprint server's abstract is no longer prose.
ABSTRACT_MARKERS = ("TOC Graphic", "Graphical Abstract", "O_FIG O_LINKSMALLFIG", "O_FIG\nO_LINKSMALLFIG")

_NULL_LIKE = ("nothing", "null", "missing")


def text_or_blank(c: Column) -> Column:
    """Null is blank."""
    return F.coalesce(c.cast("string"), F.lit(""))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def field(c: Column) -> Column:
    """A field's text without white space around it; null is blank."""
    return stripped(text_or_blank(c))


def known(c: Column) -> Column:
    """A field's text, where null and the words that stand for null are blank."""
    t = text_or_blank(c)
    return F.when(F.lower(stripped(t)).isin(*_NULL_LIKE), F.lit("")).otherwise(t)


def squashed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return stripped(F.regexp_replace(c, r"(?U)\s+", " "))


def first_non_empty(*columns: Column) -> Column:
    """The first column whose text isn't blank."""
    return F.coalesce(*(F.when(field(c) != "", c) for c in columns))


def clip(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def strip_markdown(c: Column) -> Column:
    """Plain text of markdown: tags, link targets and marks go, three entities are decoded."""
    out = F.regexp_replace(c, "<[^>]+>", " ")
    out = F.regexp_replace(out, r"\[([^\]]+)\]\([^)]+\)", "$1")
    out = F.regexp_replace(out, r"[*_`#>{}\[\]]", " ")
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return squashed(out)


def strip_markup(c: Column) -> Column:
    """Plain text of an archive title: tags go, escapes and five entities are decoded."""
    out = F.regexp_replace(text_or_blank(c), "<[^>]+>", " ")
    out = F.regexp_replace(out, r"\\([*_`\[\]])", "$1")
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return squashed(out)


def decode_xml(c: Column) -> Column:
    out = text_or_blank(c)
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def repair_xml(c: Column) -> Column:
    """Bare ampersands of a malformed document, escaped."""
    return F.regexp_replace(c, "&(?!amp;|lt;|gt;|quot;|apos;|#)", "&amp;")


def escape_markdown(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for sign in "*_`[]":
        out = F.replace(out, F.lit(sign), F.lit("\\" + sign))
    return stripped(F.replace(out, F.lit("\n"), F.lit(" ")))


def link_target(c: Column, empty: str = "#") -> Column:
    url = field(c)
    return F.when(url == "", F.lit(empty)).otherwise(F.concat(F.lit("<"), url, F.lit(">")))


def clean_url(c: Column) -> Column:
    return stripped(F.regexp_replace(F.regexp_replace(field(c), "^<", ""), r"(?U)>\s*$", ""))


def clean_preprint_abstract(c: Column, markers: tuple[str, ...] = ABSTRACT_MARKERS) -> Column:
    """Cut before each marker in turn, unless the text starts with it."""
    out = c
    for m in markers:
        at = F.locate(m, out)
        out = F.when(at > 1, stripped(F.left(out, at - 1))).otherwise(out)
    return out


def clean_break_abstract(c: Column) -> Column:
    """Text between the first and the second line break, without a trailing citation in brackets."""
    out = F.regexp_replace(c, r"(?is)^.*?<br\s*/?>", "")
    out = F.regexp_replace(out, r"(?is)<br\s*/?>.*$", "")
    out = F.regexp_replace(out, "<[A-Za-z/][^>]*>", "")
    return squashed(F.regexp_replace(out, r"(?U)\s*\[[^\]]+\]\s*$", ""))


def drop_boilerplate(c: Column, publisher: str) -> Column:
    """Without a feed's opening 'publisher, published online: date; doi:...' note."""
    return stripped(F.regexp_replace(c, rf"(?is)^\s*{publisher}[^,]*,\s*published online:[^;]*;\s*doi:\s*\S+\s*", ""))


def clean_author(c: Column) -> Column:
    """A name without the mail address around or inside it."""
    s = field(c)
    inner = F.nullif(F.regexp_extract(s, r"(?U)^[^@\s]+@[^@\s]+\s+\((.+)\)$", 1), F.lit(""))
    s = F.coalesce(stripped(inner), s)
    s = F.regexp_replace(s, r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "")
    return squashed(F.regexp_replace(stripped(s), r"^\((.+)\)$", "$1"))


def split_authors(c: Column) -> Column:
    """Names of a list: parted by semicolons if there are any, else by commas."""
    c = text_or_blank(c)
    parts = F.when(c.contains(";"), F.split(c, ";")).otherwise(F.split(c, ","))
    return F.filter(F.transform(parts, stripped), lambda p: p != "")


def distinct_authors(names: Column) -> Column:
    """Names in order, each once whatever its case."""
    def add(acc: Column, name: Column) -> Column:
        return F.when(F.array_contains(F.transform(acc, F.lower), F.lower(name)), acc).otherwise(F.concat(acc, F.array(name)))

    return F.aggregate(names, F.array().cast("array<string>"), add)


def normal_name(c: Column, keep_commas: bool = True) -> Column:
    """Lower case, without accents; points, hyphens and apostrophes as spaces. Commas stay part of a name unless told otherwise."""
    out = F.translate(F.lower(c), ACCENTED, PLAIN)
    return squashed(F.regexp_replace(out, r"[.\-']" if keep_commas else r"[.\-',]", " "))


def words(c: Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """Topic words: ASCII letters and digits in lower case, three or more, none of the stop words."""
    # as strip_markdown, but for marks and white space, which the last step turns into spaces anyway
    out = F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\[([^\]]+)\]\([^)]+\)", "$1")
    for entity in ("&amp;", "&lt;", "&gt;"):
        out = F.replace(out, F.lit(entity), F.lit("&" if entity == "&amp;" else " "))
    cleaned = F.regexp_replace(F.lower(out), "[^a-z0-9]+", " ")
    return F.filter(F.split(cleaned, " "), lambda t: (F.length(t) >= 3) & ~t.isin(*stopwords))


def bigrams(tokens: Column) -> Column:
    """Neighbours joined by an underscore."""
    n = F.size(tokens)
    pairs = F.zip_with(F.slice(tokens, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit("_"), b))
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def terms(c: Column) -> Column:
    """Topic words, then their bigrams (formed once stop words are gone)."""
    w = words(c)
    return F.concat(w, bigrams(w))


def extractive_summary(c: Column) -> Column:
    """The first sentence of 40 to 600 characters, else the first 360 characters."""
    clean = squashed(text_or_blank(c))
    sentence = F.nullif(F.regexp_extract(clean, r"^([\s\S]{40,600}?[.!?])(?:\s|$)", 1), F.lit(""))
    excerpt = F.when(F.length(clean) > 360, F.concat(stripped(F.left(clean, F.lit(360))), F.lit("…"))).otherwise(clean)
    return F.when(clean == "", F.lit("Summary unavailable.")).otherwise(F.coalesce(stripped(sentence), excerpt))


def paper_text(title: Column, abstract: Column, source: Column) -> Column:
    return F.concat_ws(" ", known(title), known(abstract), known(source))


def section_of_heading(line: Column) -> Column:
    return F.when(line.rlike(r"^#\s+Featured Papers\s*$"), "featured").when(line.rlike(r"^##\s+Some Papers\s*$"), "some").when(line.rlike(r"^##\s+More Papers\s*$"), "more")


def section_weight(section: Column, default: float = 0.0) -> Column:
    """2 for featured and some, 1 for more; `default` for any other."""
    return F.when(section.isin("featured", "some"), 2.0).when(section == "more", 1.0).otherwise(F.lit(default))
