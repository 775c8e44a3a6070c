"""Specification books: sections with ends, references to rooms, inverted indexes, photo links."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators.keep import keep_first
from ..operators.sections import dominant_font, filled, gathered, is_title, title_level
from ..operators.within import held

c = F.col
ROOM, NORM = fixed.ROOM_REFERENCE, fixed.STANDARD_REFERENCE


def titled_sections(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Sections of blocks in reading order: title, level, code, content and the section above; a title of level 3 stays inside.

    blocks: keys, page, ord, text, x0, y0, size, bold.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("page", "y0", "x0", "ord"))
    b = blocks.join(dominant_font(blocks, keys), keys).withColumn("pos", place)
    b = b.withColumn("level", F.when(is_title(c("text"), c("size"), c("dominant"), c("bold")), title_level(c("size"), c("dominant"), c("bold"))))
    b = filled(b, keys, ["pos"], c("level") <= 2)
    heads = b.filter(c("pos") == c("section")).select(*keys, "section", c("text").alias("title"), "level", "page", text.csi_code(c("text")).alias("code"))
    above = Window.partitionBy(*keys).orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumn("parent", F.when(c("level") > 1, F.last(F.when(c("level") == 1, c("section")), ignorenulls=True).over(above)))
    body = gathered(b.filter((c("pos") != c("section")) & c("section").isNotNull()), [*keys, "section"], "pos")
    return heads.join(body, [*keys, "section"], "left").select(*heads.columns, F.coalesce("content", F.lit("")).alias("content"))


def room_references(blocks: DataFrame, keys: list[str], whole_words: bool = True) -> DataFrame:
    """Rooms that texts refer to, the first mention of each; standards and what stands beside them are none.

    whole_words=False also takes ISOLATION or NORMAL for a standard.
    """
    each = blocks.withColumn("s", F.explode(text.found(c("text"), ROOM, 3)))
    part = lambda i: F.nullif(c("s.groups")[i - 1], F.lit(""))
    each = each.withColumns({"room_ref": F.coalesce(part(1), part(2), part(3)), "context": text.around(c("text"), c("s"), 30, 50)})
    words = "|".join(fixed.STANDARDS)
    about = c("context").rlike(rf"(?iuU)\b(?:{words})\b") if whole_words else c("context").rlike(f"(?iu)(?:{words})")
    good = each.filter(c("room_ref").isNotNull() & ~c("room_ref").rlike(NORM) & ~about)
    return keep_first(good, [*keys, "room_ref"], ["ord", c("s.start")]).select(*keys, "room_ref", "context", "page")


def code_references(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Section codes that texts name, each once: the first mention with a title, else the first.

    blocks: keys, page, ord, text, x0, y0, size, bold.  Adds division, title (the first of the texts about it in capitals,
    of more than five letters and not a section header), context (three texts before and two behind on the page, those
    of more than three letters) and is_header.
    """
    b = blocks.join(dominant_font(blocks, keys), keys).withColumn("text", text.bare(c("text")))
    w = Window.partitionBy(*keys, "page").orderBy("y0", "x0", "ord")
    long = lambda a: F.filter(a, lambda t: F.length(t) > 3)
    before, behind = F.collect_list("text").over(w.rowsBetween(-3, -1)), F.collect_list("text").over(w.rowsBetween(1, 2))
    b = b.withColumns({"_before": long(before), "_behind": long(behind)})
    each = b.withColumn("s", F.explode(text.spans(c("text"), fixed.CODE))).withColumn("code", text.csi_code(c("s.match")))
    about = F.concat("_before", F.array("text"), "_behind")
    heads = F.filter(F.slice(about, 1, F.size(about) - 1), lambda t: (F.upper(t) == t) & (F.lower(t) != t) & (F.length(t) > 5) & ~F.startswith(t, F.lit("SECTION")))
    each = each.select(*keys, "page", "ord", c("s.start").alias("_at"), "code", F.left("code", F.lit(2)).alias("division"), F.coalesce(F.get(heads, F.lit(0)), F.lit("")).alias("title"), F.left(F.array_join(about, " | "), F.lit(500)).alias("context"), is_title(c("text"), c("size"), c("dominant"), c("bold")).alias("is_header"))
    return keep_first(each, [*keys, "code"], [c("title") == "", "ord", "_at"]).drop("_at")


def local_references(t: Column) -> Column:
    """Rooms that a text refers to in any of the older forms: sorted, each once, in capitals; years, codes and standards are none."""
    found = F.flatten(F.array(*(F.regexp_extract_all(t, F.lit(p), F.lit(g)) for p, g in fixed.LOCAL_REFERENCES)))
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, F.upper), lambda x: ~x.rlike(r"^\d{4,}$") & ~x.rlike("^(CSA|ASTM|CAN|ISO)"))))


def chunks_of_local(ref: str, index: DataFrame, chunks: DataFrame, limit: int = 5) -> DataFrame:
    """Chunks of the sections that name a room, if they hold it themselves; where none does, the first chunks that hold it, with or without the dash.

    index: room_ref, codes; chunks: id, code, text, ord.
    """
    own, bare_ref = ref.upper().strip(), ref.upper().strip().replace("-", "")
    codes = index.filter(F.upper("room_ref") == own).select(F.explode("codes").alias("code")).distinct()
    sure = chunks.join(codes, "code", "left_semi").filter(F.contains(F.upper("text"), F.lit(own))).select("id", "ord", F.lit(1.0).alias("relevance"))
    loose = chunks.filter(F.contains(F.upper("text"), F.lit(own)) | F.contains(F.upper("text"), F.lit(bare_ref))).orderBy("ord").limit(limit).select("id", "ord", F.lit(0.7).alias("relevance"))
    return (sure if sure.limit(1).count() else loose).orderBy("ord")


def fuzzy_keys(asked: DataFrame, table: DataFrame, key: str, of: str = "asked") -> DataFrame:
    """Every distinct asked key with the row of ``table`` that answers it: of an equal key in any case, else the first, by
    key, that holds what is asked or is held by it.  Keys that nothing answers, null and empty ones have no row.

    Both ways are containment joins of distinct texts; ``way`` is 0 for an equal key, else 1.
    """
    own = asked.select(F.col(of).alias("_asked")).filter("_asked <> ''").distinct().withColumn("_q", F.upper("_asked"))
    keys = table.select(F.col(key).alias("_key")).filter("_key <> ''").distinct().withColumn("_k", F.upper("_key"))
    texts, items = own.select("_q").distinct(), keys.select("_k").distinct()
    held_by = held(texts, items, "_q", "_k", text="_q", item="_k")
    holds = held(items, texts, "_k", "_q", text="_k", item="_q")
    hits = held_by.select("_q", "_k").unionByName(holds.select("_q", "_k")).distinct().join(keys, "_k")
    best = hits.groupBy("_q").agg(F.min(F.struct(F.when(c("_k") == c("_q"), 0).otherwise(1).alias("way"), c("_key"))).alias("b"))
    named = own.join(best, "_q").select(c("_asked").alias(of), c("b._key").alias("_key"), c("b.way").alias("way"))
    rows = keep_first(table, [key], [F.xxhash64(*table.columns)])  # of rows that share a key, one
    return named.join(rows, c("_key") == c(key)).drop("_key")


def fuzzy_key(asked: str, table: DataFrame, key: str) -> DataFrame:
    """The row of an equal key in any case; else the first, by key, that holds what is asked or is held by it."""
    k, q = F.upper(key), F.lit(asked.upper())
    way = F.when(k == q, 0).when(F.contains(k, q) | F.contains(q, k), 1)
    return table.filter(k != "").withColumn("_way", way).filter("_way is not null").orderBy("_way", key).limit(1).drop("_way")


def room_sections(spark) -> DataFrame:
    """(type, code, required): sections that a room type requires or commonly has."""
    rows = [(k, code, need) for k, both in fixed.ROOM_SECTIONS.items() for need, codes in zip((True, False), both) for code in codes]
    return spark.createDataFrame(rows, "type string, code string, required boolean")


def section_titles(spark) -> DataFrame:
    return spark.createDataFrame(list(fixed.SECTION_TITLES.items()), "code string, title string")


def material_index(chunks: DataFrame) -> DataFrame:
    """For each kind of material: its chunks (by words), the first five of them, and its sections (of those chunks, or by number).  chunks: id, ord, code, text."""
    low = F.lower("text")
    kinds = F.array(*(F.struct(F.lit(k).alias("material"), text.any_of(low, words).alias("named"), F.coalesce(F.left("code", F.lit(5)).isin(heads), F.lit(False)).alias("coded")) for k, (words, heads) in fixed.MATERIALS.items()))
    each = chunks.select("id", "ord", "code", F.explode(kinds).alias("k")).select("id", "ord", "code", "k.*").filter("named or coded")
    sums = each.withColumn("_r", F.row_number().over(Window.partitionBy("material", "named").orderBy("ord", "id")))
    few = sums.filter("named and _r <= 5").groupBy("material").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "id"))), lambda r: r["id"]).alias("samples"))
    out = each.groupBy("material").agg(F.count_if("named").alias("n_chunks"), F.array_sort(F.collect_set("code")).alias("codes"))
    domain = chunks.sparkSession.createDataFrame([(k,) for k in fixed.MATERIALS], "material string")
    none = F.array().cast("array<string>")
    return domain.join(out, "material", "left").join(few, "material", "left").select("material", F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), F.coalesce("codes", none).alias("codes"), F.coalesce("samples", none).alias("samples"))


def unified_entries(rooms: DataFrame, chunks: DataFrame) -> DataFrame:
    """Search entries of rooms (with the sections of their type) and of sections (with their chunks, rooms and types): kind, id, codes, search_text.

    rooms: id, name; chunks: id, code, title, text.
    """
    spark = rooms.sparkSession
    kinds, titles = room_sections(spark), section_titles(spark)
    by_type = kinds.join(titles, "code", "left").groupBy("type").agg(F.array_sort(F.collect_list(F.struct(~c("required"), "code", F.coalesce("title", F.lit("")).alias("title")))).alias("s"))
    typed = rooms.withColumn("type", text.index_type(c("name"), list(fixed.ROOM_SECTIONS))).join(F.broadcast(by_type), "type", "left")
    codes = F.transform("s", lambda x: x["code"])
    told = F.array_join(F.transform("s", lambda x: F.concat_ws(" ", x["code"], x["title"])), " ")
    r = typed.select(F.lit("room").alias("kind"), F.concat(F.lit("room_"), "id").alias("id"), F.coalesce(codes, F.array().cast("array<string>")).alias("codes"), F.concat_ws(" ", "id", "name", "type", told).alias("search_text"))
    of_code = kinds.groupBy("code").agg(F.array_sort(F.collect_set("type")).alias("types"))
    own = chunks.filter("code <> ''").groupBy("code").agg(F.min("title").alias("own_title"))
    s = own.join(F.broadcast(titles), "code", "left").join(F.broadcast(of_code), "code", "left")
    s = s.select(F.lit("section").alias("kind"), F.concat(F.lit("csi_"), F.replace("code", F.lit(" "), F.lit("_"))).alias("id"), F.array("code").alias("codes"), F.concat_ws(" ", "code", F.coalesce("title", "own_title"), F.array_join("types", " ")).alias("search_text"))
    return r.unionByName(s)


def index_quality(rooms: DataFrame) -> DataFrame:
    v = c("confidence")
    return rooms.agg(F.bround(F.avg(v), 3).alias("mean"), F.count(v).alias("n"), F.count_if(v >= 0.8).alias("high"), F.count_if(v < 0.5).alias("low"))


def asked_about(question: str) -> dict:
    """What a question is about: a room, a kind of material, a maker; the first of them decides how it is answered."""
    low, room = question.lower(), None
    for p in (r"\blocal\s+([A-D]-?\d{3})\b", r"\blocal\s+(\d{3})\b", r"\b([A-D]-\d{3})\b"):
        if m := re.search(p, question, re.IGNORECASE):
            room = m[1].upper()
            break
    kind = next((k for k, words in fixed.ASKED_WORDS.items() if any(w in low for w in words)), None)
    return {"local": room, "type": kind, "manufacturer": next((m.upper() for m in fixed.ASKED_MAKERS if m in low), None), "free_text": question}


def ask_chunks(question: str, chunks: DataFrame, index: DataFrame, limit: int = 10) -> DataFrame:
    """(id, ord, relevance): chunks that answer a question, best first: of the room, else of the material, else of the maker, else by words."""
    about, low = asked_about(question), F.lower("text")
    if about["local"]:
        found = chunks_of_local(about["local"], index, chunks)
        if not about["type"]:
            return found
        heads = [k[:5] for k in fixed.ASKED_SECTIONS.get(about["type"], [])]
        both = found.join(chunks.filter(F.left("code", F.lit(5)).isin(heads)).select("id"), "id", "left_semi")
        if both.limit(1).count():
            return both
        more = of_material(about["type"], chunks, limit)
        return found.unionByName(more.join(found.select("id"), "id", "left_anti"))
    if about["type"]:
        return of_material(about["type"], chunks, limit)
    if about["manufacturer"]:
        return chunks.filter(F.contains(low, F.lit(about["manufacturer"].lower()))).orderBy("ord").limit(limit).select("id", "ord", F.lit(0.8).alias("relevance"))
    words = question.lower().split()
    hits = sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0)) / F.lit(float(max(1, len(words))))
    return chunks.select("id", "ord", hits.alias("relevance")).orderBy(F.desc("relevance"), "ord").limit(limit).filter("relevance > 0")


def of_material(kind: str, chunks: DataFrame, limit: int = 10) -> DataFrame:
    """Chunks of a material's sections, then those that hold one of its words."""
    coded = F.coalesce(F.left("code", F.lit(5)).isin([k[:5] for k in fixed.ASKED_SECTIONS.get(kind, [])]), F.lit(False))
    named = text.any_of(F.lower("text"), [w for w in fixed.ASKED_WORDS.get(kind, [kind])])
    return chunks.withColumn("relevance", F.when(coded, 1.0).when(named, 0.8)).filter("relevance is not null").orderBy(F.desc("relevance"), "ord").limit(limit).select("id", "ord", "relevance")


def validation_rate(log: DataFrame) -> DataFrame:
    """Of a log of checks (id, verdict): how many, how many confirmed or corrected, and their share."""
    sums = log.agg(F.count("*").alias("n"), F.count_if(c("verdict").isin("confirmed", "corrected")).alias("verified"))
    return sums.withColumn("rate", F.coalesce(F.try_divide(c("verified"), c("n")), F.lit(0.0)))


def section_ends(heads: DataFrame, keys: list[str], last_page: int) -> DataFrame:
    """The page on which each section ends: that of the next header."""
    follow = F.lead("page").over(Window.partitionBy(*keys).orderBy("page", "ord"))
    return heads.withColumn("end_page", F.coalesce(follow, F.lit(last_page)))


def clean_page(page: Column, heads: list[str]) -> Column:
    """A page's text without its running heads and bare page numbers."""
    drop = "|".join([r"\s*\d+\s*", r"\s*Page \d+( of \d+)?\s*", *heads])
    return F.array_join(F.filter(F.split(page, "\n", -1), lambda x: ~x.rlike(f"(?iu)^(?:{drop})$")), "\n")


def valid_local(ref: Column) -> Column:
    """A reference to a room and not to a drawing sheet."""
    return ref.rlike(r"^[A-Z]?-?\d{3}[A-Z]?(-\d+)?$") & ~ref.rlike(r"^[A-Z]-?[0-9]50$")


def chunk_rooms(chunks: DataFrame, rooms: DataFrame) -> DataFrame:
    """(chunk_id, room_id): chunks that name a known room; each chunk is read once."""
    refs = chunks.select(c("id").alias("chunk_id"), F.explode(F.array_distinct(F.regexp_extract_all(F.upper("text"), F.lit(r"\b([A-Z]?-?\d{3})\b"), F.lit(1)))).alias("ref"))
    keys = rooms.select(c("id").alias("room_id"), F.explode(F.array_distinct(F.array(F.upper("id"), F.regexp_replace(F.upper("id"), "^[A-Z]-", "")))).alias("ref"))
    return refs.join(keys, "ref").select("chunk_id", "room_id").distinct()


def required_chunks(rooms: DataFrame, chunks: DataFrame, required: DataFrame, related: DataFrame) -> DataFrame:
    """Chunks of the sections that a room's type asks for, less those that name the room.  required: type, code."""
    asked = rooms.select(c("id").alias("room_id"), "type").join(required, "type").join(chunks.select(c("id").alias("chunk_id"), "code"), "code").select("chunk_id", "room_id").distinct()
    return asked.join(related, ["chunk_id", "room_id"], "left_anti")


def section_index(chunks: DataFrame, related: DataFrame) -> DataFrame:
    """Chunks, a title and the rooms of each section code."""
    named = chunks.select("code", "title", c("id").alias("chunk_id")).join(related, "chunk_id", "left")
    return named.groupBy("code").agg(F.count_distinct("chunk_id").alias("n_chunks"), F.min("title").alias("title"), F.array_sort(F.collect_set("room_id")).alias("rooms"))


def local_index(sections: DataFrame) -> DataFrame:
    """For each room the sections that name it.  sections: code, locals array."""
    return sections.select("code", F.explode("locals").alias("room_ref")).groupBy("room_ref").agg(F.array_sort(F.collect_set("code")).alias("codes"))


def photo_room(note: Column) -> Column:
    """The room that a photo's text names."""
    t = F.upper(note)
    found = [F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r"\b([ABC]-\d{3}(?:-\d+)?)\b", r"(?U)LOCAL\s*#?\s*(\d{3})\b", r"\b(\d{3})\b")]
    return F.coalesce(*found)


def photos(rows: DataFrame, rooms: DataFrame, links: DataFrame) -> DataFrame:
    """The room of each photo: by its notes, else by what was seen on it, else by nearness to the site, else by hand.

    rows: photo_id, notes, seen, metres (null without a place); links: photo_id, room_id.
    """
    known = rooms.select(c("id").alias("room_id"), F.explode(F.array_distinct(F.array("id", F.regexp_replace("id", "^[A-Z]-", "")))).alias("key"))
    first = known.groupBy("key").agg(F.min("room_id").alias("room_id"))
    side = lambda n: first.select(c("key").alias(f"_{n}_key"), c("room_id").alias(f"_{n}"))
    out = rows.withColumns({"_n_key": photo_room(c("notes")), "_s_key": photo_room(c("seen"))}).join(side("n"), "_n_key", "left").join(side("s"), "_s_key", "left").join(links.select("photo_id", c("room_id").alias("_l")), "photo_id", "left")
    way = F.when(c("_n").isNotNull(), "notes").when(c("_s").isNotNull(), "seen").when(c("_l").isNotNull(), "manual").when(c("metres") <= 100, "site").otherwise("none")
    return out.select("photo_id", F.coalesce("_n", "_s", "_l").alias("room_id"), way.alias("method"), F.when(way == "notes", 0.95).when(way == "seen", 0.8).when(way == "manual", 1.0).when(way == "site", 0.3).otherwise(0.0).alias("confidence"))


def activities(log: DataFrame) -> DataFrame:
    """Entries of an activity log: day, and the room, kind and note that each states.  log: doc, text with dated headings."""
    parts = F.split("text", r"(?m)^## (?=\d{4}-\d{2}-\d{2})")
    each = log.select("doc", F.posexplode(parts).alias("n", "t")).filter("n > 0")
    field = lambda k: F.nullif(text.bare(F.regexp_extract("t", rf"(?imu)^\s*[-*]?\s*{k}\s*:\s*(.+)$", 1)), F.lit(""))
    return each.select("doc", "n", F.regexp_extract("t", r"^(\d{4}-\d{2}-\d{2})", 1).alias("day"), field("local").alias("room"), field("type").alias("kind"), field("note").alias("note"))


def validated(rooms: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rooms after a check: confirmed ones are surer, a corrected id replaces the old one, which is kept.  verdicts: id, verdict, new_id."""
    v = rooms.join(verdicts.select("id", "verdict", "new_id"), "id", "left")
    right = c("verdict") == "corrected"
    out = v.withColumns({"original_id": F.when(right, c("id")), "confidence": F.when(c("verdict") == "confirmed", 0.95).when(right, 0.90).otherwise(c("confidence"))})
    return out.withColumn("id", F.when(right, c("new_id")).otherwise(c("id"))).drop("verdict", "new_id")
