"""Archive editions: markdown lines to entries by gaps and islands, and back. Lines are rows (file, pos, line). What a line takes over from lines before or
behind it is found by scans in two levels, so one file may hold all lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_url, section_of_heading, section_weight, strip_markdown, strip_markup, stripped
from .scan import SIZE, Ahead, scan

_LINKED, _SPLIT, _OPEN, _NEXT = r"^####\s+\[(.*)\]\((.*)\)\s*$", r"^####\s+\[(.*)\]\s*$", r"^####\s+\[(.*)\s*$", r"^\]?\((.*)\)\s*$"


def lines_of(files: DataFrame) -> DataFrame:
    """(file, pos, line) of texts (file, text)."""
    return files.select("file", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"))


def carry_forward(rows: DataFrame, value: Column, by: str, order: str, name: str, size: int = SIZE) -> DataFrame:
    """Adds the last value that isn't null, from this row or one before."""
    return scan(rows, by, order, last={name: value}, size=size)


def look_ahead(rows: DataFrame, value: Column, by: str, order: str, name: str, reach: int = 20, last: bool = True, size: int = SIZE) -> DataFrame:
    """Adds the last (or first) value that isn't null, from this row to `reach` rows on."""
    return scan(rows, by, order, ahead={name: Ahead(value, reach, last)}, size=size)


def _headings(lines: DataFrame, size: int, **more: dict[str, Column]) -> DataFrame:
    bare = lines.select("file", "pos", stripped(F.col("line")).alias("line"))
    line = F.col("line")
    linked = line.rlike(_LINKED)
    loose = ~linked & line.rlike(_OPEN)
    title = F.when(linked, F.regexp_extract(line, _LINKED, 1)).when(line.rlike(_SPLIT), F.regexp_extract(line, _SPLIT, 1)).when(loose, F.regexp_extract(line, _OPEN, 1))
    marked = bare.withColumns({"heading": section_of_heading(line), "title": stripped(title)})
    # of the lines beside it a heading only needs to know whether one goes on and the other opens
    seen = scan(marked, "file", "pos", before={"opened": ~line.rlike(_LINKED) & line.rlike(_OPEN)}, after={"next": F.regexp_extract(line, _NEXT, 1), "goes_on": line.rlike(_NEXT)}, size=size, **more)
    url = F.when(linked, F.regexp_extract(line, _LINKED, 2)).when(loose & F.coalesce("goes_on", F.lit(False)), F.col("next")).when(loose, F.lit(""))
    continues = F.coalesce("opened", F.lit(False)) & line.rlike(_NEXT)
    return seen.withColumns({"url": clean_url(url), "continues": continues}).drop("opened", "next", "goes_on")


def entries(lines: DataFrame, size: int = SIZE) -> DataFrame:
    """(file, pos, title, url, section, text, weight) of every entry. A section heading ends an entry; an entry before any is in `more`."""
    starts = F.col("heading").isNotNull() | F.col("title").isNotNull()
    marked = _headings(lines, size, last={"section": F.col("heading")}, total={"island": starts.cast("int")})
    after_break = F.when(F.col("line").rlike(r"(?i)<br\s*/?>"), F.get(F.split("line", r"(?i)<br\s*/?>", 2), F.lit(1))).otherwise(F.col("line"))
    body = F.when(F.col("title").isNull() & ~F.col("continues") & ~F.startswith(F.col("line"), F.lit(":::")), F.nullif(strip_markdown(after_break), F.lit("")))
    parts = F.array_sort(F.collect_list(F.when(body.isNotNull(), F.struct("pos", body.alias("text")))))
    grouped = marked.groupBy("file", "island").agg(F.min("pos").alias("pos"), F.max("title").alias("title"), F.max("url").alias("url"), F.max("section").alias("section"), F.max(F.col("heading").isNotNull()).alias("is_section"), parts.alias("parts"))
    text = strip_markdown(F.concat_ws(" ", "title", F.array_join(F.transform("parts", lambda p: p["text"]), " ")))
    section = F.coalesce("section", F.lit("more"))
    found = grouped.where(~F.col("is_section") & (F.coalesce("title", F.lit("")) != "")).select("file", "pos", "title", "url", section.alias("section"), text.alias("text"), section_weight(section, 1.0).alias("weight"))
    return found.where("text <> ''")


def titles_and_links(lines: DataFrame, size: int = SIZE) -> DataFrame:
    """(file, pos, title, link) of headings that have a link on their line or the next."""
    return _headings(lines, size).where("title IS NOT NULL AND url <> ''").select("file", "pos", strip_markup(F.col("title")).alias("title"), F.col("url").alias("link"))


def normalized_front_matter(text: Column, start: Column, end: Column) -> Column:
    """Title, edition_id and window_end_date set to a window; lines that aren't there are added."""
    title = F.concat(F.lit('title: "'), F.date_format(start, "MMM d yy"), F.lit('"'))
    out = F.regexp_replace(text, F.lit(r"""(?m)\A([\s\S]*?)^title:[ \t]*["']?.*?["']?[ \t]*$"""), F.concat(F.lit("$1"), title))
    for name, after, value in (("edition_id", "title", start), ("window_end_date", "edition_id", end)):
        own = F.concat(F.lit(f'{name}: "'), F.date_format(value, "yyyy-MM-dd"), F.lit('"'))
        there = F.regexp_replace(out, F.lit(rf"(?m)\A([\s\S]*?)^{name}:[ \t]*.*$"), F.concat(F.lit("$1"), own))
        added = F.regexp_replace(out, F.lit(rf"(?m)\A([\s\S]*?)^({after}:.*)$"), F.concat(F.lit("$1$2\n"), own))
        out = F.when(out.rlike(f"(?m)^{name}:"), there).otherwise(added)
    return out
