"""Coverage: facets, regions, languages, genres, and what is missing."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import body, chars_in, fold, java, let, tokens

HEAD_CHARS = 4000
NONE = "(none)"

# Facet rules; a text has every key whose pattern it matches.
DOMAIN = {
    "hvac_energy": r"hvac|heat pump|ventilat|air.?condition|chiller|boiler|refriger|energy efficien|thermal comfort|insulat|energy performance|节能|暖通|空调|供暖|采暖|保温|断熱|省エネ|heizung|dämmung|wärme|isolation therm",
    "architecture": r"architect|building design|floor plan|spatial|facade|interior|accessib|建筑设计|意匠|entwurf",
    "structural": r"structural|load.?bearing|seismic|beam|column|truss|girder|reinforced concrete|steel structure|结构|抗震|耐震|tragwerk|charpente",
    "water": r"water supply|wastewater|sewer|drainage|plumbing|storm.?water|potable|给排水|排水|下水道|assainissement",
    "transport_infra": r"highway|roadway|railway|railroad|bridge|tunnel|pavement|asphalt|traffic|transit|桥梁|隧道|道路|铁路|公路|straße|pont",
    "urban": r"urban|city plan|zoning|land use|master.?plan|neighborhood|public space|城市规划|市政|都市計画|städtebau|urbanisme",
    "fire_safety": r"\bfire\b|sprinkler|smoke|egress|flammab|combusti|防火|消防|brandschutz|incendie",
    "geotech": r"geotechnic|foundation|\bsoil\b|\bpile\b|excavat|retaining|地基|岩土|基礎|geotechnik",
    "materials": r"cement|concrete|aggregate|timber|masonry|coating|admixture|durability|corrosion|建材|混凝土|水泥|baustoff|matériau",
    "lighting_elec": r"lighting|luminair|daylight|electrical system|wiring|照明|电气|beleuchtung|éclairage",
    "controls_bas": r"bacnet|building automation|\bbas\b|thermostat|setpoint|sensor|fault detection|smart building|楼宇自控|控制系统",
    "constr_mgmt": r"construction management|project delivery|cost estimat|scheduling|procurement|construction safety|施工管理|造价|工程管理|bauleitung",
}
LIFECYCLE = {
    "planning": r"\bplanning\b|feasibility|siting|pre.?design|programming phase|规划|企画",
    "design": r"\bdesign\b|specification|detailing|设计|設計|entwurf|conception",
    "construction": r"construction|erection|formwork|installation|prefabricat|施工|工法|bauausführung",
    "commissioning": r"commissioning|functional test|startup|acceptance test|调试|试运行|inbetriebnahme",
    "operation": r"operation|maintenance|facility management|\bo&m\b|energy management|fault detection|运行|维护|运维|betrieb|exploitation",
    "retrofit": r"retrofit|renovation|refurbish|rehabilitat|modernis|upgrade|改造|翻新|sanierung",
    "demolition": r"demolition|deconstruction|end.of.life|recycl|circular econom|拆除|废弃|rückbau",
}
DATATYPE = {
    "code_standard": r"(building|energy|fire|plumbing|electrical) code|\bstandard\b|regulation|ordinance|directive|approved document|规范|标准|条例|norm\b|richtlinie",
    "manual_guide": r"manual|guidebook|handbook|guideline|guidance|how.to|best practice|手册|指南|指引|leitfaden|guide\b",
    "dataset_ts": r"dataset|time.?series|measured data|monitoring data|smart meter|benchmark(ing)? data|数据集|实测数据",
    "case_study": r"case stud|demonstration|pilot project|lessons learned|案例|示范工程",
    "drawing_bim": r"\bbim\b|\bifc\b|\bcad\b|drawing|blueprint|图纸|図面",
    "research": r"study|analysis|assessment|evaluation|experiment|simulation|modeling|研究|分析|untersuchung|étude",
}
BUILDING = {
    "residential": r"residential|dwelling|housing|home[s ]|apartment|multifamily|住宅|居住|wohn",
    "office": r"\boffice\b|commercial building|办公|事務所|büro",
    "hospital": r"hospital|healthcare|clinic|医院|病院|krankenhaus",
    "school": r"school|education building|classroom|campus|学校|校园|schule",
    "industrial": r"industrial|factory|manufacturing plant|warehouse|工厂|仓库|industrie",
    "datacenter": r"data cent(er|re)|server room|数据中心|机房",
    "hotel_retail": r"hotel|retail|shopping|supermarket|restaurant|酒店|商场|商店",
}
FACETS = {"domain": DOMAIN, "lifecycle": LIFECYCLE, "datatype": DATATYPE, "bldgtype": BUILDING}
# Regions by source, by country of a patent, and by words of the text's beginning.
SOURCE_REGION = {
    "osti": "US", "nist_crossref": "US", "gov_cec": "US", "gov_nyserda": "US", "nrel": "US",
    "gov_uk": "UK", "jrc": "EU", "openaire": "EU", "kitopen": "EU", "sdz_hdz": "EU", "ademe": "EU",
    "bri_japan": "JP", "nilim_japan": "JP", "worldbank": "Global", "iea": "Global",
    "oapen": "Global", "zenodo": "Global", "internet_archive": "US/UK-hist",
}
PATENT_REGION = {"us": "US", "cn": "CN", "ep": "EU", "de": "EU"}
TEXT_REGION = {
    "CN": r"\bchina\b|chinese|中国", "JP": r"\bjapan\b|日本", "EU": r"\beu\b|european|europe\b",
    "US": r"united states|\bu\.s\.", "UK": r"united kingdom|\buk\b|england|scotland|wales",
    "Nordic": r"sweden|swedish|norway|denmark|danish|finland|finnish|nordic|iceland",
}
UNMAPPED = "(unmapped)"
REGION_COLUMNS = ["US", "CN", "EU", "UK", "JP", "Global", "Nordic"]
# Words that vote for a language; the first of equal votes wins.
LANGUAGE_WORDS = {
    "de": "der die das und für nicht werden eine".split(),
    "fr": "le la les des une dans pour avec est".split(),
    "es": "el los las una para con por del".split(),
    "it": "il gli delle una per con del che".split(),
    "pt": "os uma para com não dos das".split(),
    "nl": "het een voor niet aan bij zijn".split(),
    "sv": "och att för inte som med den det".split(),
    "en": "the and of for with that this".split(),
}
LANGUAGE_MARGIN = 1.2
# Genres and where they live; genre by source, then by beginning of the source's name.
GENRES = [
    "research_papers", "books_textbooks", "us_gov_lab_reports", "international_bodies",
    "codes_standards", "public_datasets", "equipment_mfr_docs", "software_sim_docs",
    "ontology_dataspec", "practitioner_qa", "encyclopedic", "industry_ngo_utility", "patents",
]
SOURCE_GENRE = {
    "arxiv": "research_papers", "openalex": "research_papers", "academic": "research_papers",
    "osti": "us_gov_lab_reports", "gov_osti": "us_gov_lab_reports", "gov_pnnl": "us_gov_lab_reports",
    "gov_lbnl": "us_gov_lab_reports", "gov_doe": "us_gov_lab_reports", "gov_ca": "us_gov_lab_reports",
    "nist": "us_gov_lab_reports", "gsa": "us_gov_lab_reports", "naseo": "us_gov_lab_reports",
    "calnext": "us_gov_lab_reports", "wbdg": "us_gov_lab_reports", "energystar": "us_gov_lab_reports",
    "web": "us_gov_lab_reports", "eere": "us_gov_lab_reports",
    "iea_ebc": "international_bodies", "eu_jrc": "international_bodies", "iea": "international_bodies",
    "ashrae": "codes_standards", "energycodes": "codes_standards",
    "eia": "public_datasets", "openei": "public_datasets", "datasets": "public_datasets",
    "volttron": "software_sim_docs", "modelica_buildings": "software_sim_docs", "docs": "software_sim_docs",
    "brick": "ontology_dataspec", "haystack": "ontology_dataspec", "open223": "ontology_dataspec",
    "unmethours": "practitioner_qa", "wikipedia": "encyclopedic",
    "aceee": "industry_ngo_utility", "ngo_globalabc": "industry_ngo_utility",
    "openaire_deliverable": "international_bodies", "zenodo": "research_papers",
    "patents": "patents", "google_patents": "patents",
}
PREFIX_GENRE = [
    (["gh_"], "software_sim_docs"),
    (["oapen", "intechopen", "textbook", "oer", "internet_archive", "wikibooks"], "books_textbooks"),
    (["wikipedia"], "encyclopedic"),
    (["gov_uk", "sdz_at", "hdz_at", "ademe", "bri_jp", "nilim_jp"], "international_bodies"),
    (["kitopen"], "research_papers"),
    (["gov_", "doe", "eere", "epa", "fhwa", "fema", "usgs", "osha", "gsa", "nps", "hud", "usda", "wbdg", "nist", "nasa", "ornl", "sandia", "access_board", "noaa", "usbr"], "us_gov_lab_reports"),
]
# How many documents a genre needs for the next band.
BANDS = [(0, "none"), (16, "thin"), (61, "some")]


def _alternatives(pattern: str) -> list[str]:
    """A pattern cut at the bars outside of groups and classes."""
    out, depth, escaped = [""], 0, False
    for c in pattern:
        if c == "|" and not depth and not escaped:
            out.append("")
            continue
        depth += 0 if escaped else (c in "([") - (c in ")]")
        escaped = c == "\\" and not escaped
        out[-1] += c
    return out


def _always(alternative: str) -> str:
    """The longest run of characters that stands in every match of one alternative; empty if none does."""
    bare = re.sub(r"\\b", "\x00", alternative)
    while "(" in bare:
        bare = re.sub(r"\([^()]*\)[?*+]?", "\x00", bare)
    bare = re.sub(r"\[[^\]]*\][?*+]?", "\x00", bare)
    bare = re.sub(r"(?:\\.|.)[?*]|[.+]", "\x00", bare)
    return max(re.split("[\x00\\\\]", bare), key=len)


def matches(folded: Column, pattern: str) -> Column:
    """Whether a folded text matches a rule: a plain alternative is searched for as it is.

    Any other is preceded by a search for what its every match holds, so that a text without that is
    not read by the pattern.
    """
    plain, other = [], []
    for some in _alternatives(pattern):
        held = _always(some)
        if held == some:
            plain.append(some)
        else:
            test = folded.rlike("(?d)" + java(some))
            other.append(folded.contains(held) & test if held else test)
    if plain:
        other.insert(0, F.exists(F.array(*map(F.lit, plain)), lambda x: folded.contains(x)))
    return reduce(lambda x, y: x | y, other)


def facet(rules: dict[str, str], folded: Column) -> Column:
    """Keys whose pattern a folded text matches, in the rules' order; one placeholder if none does."""
    keys = F.array_compact(F.array(*[F.when(matches(folded, p), k) for k, p in rules.items()]))
    return let(keys, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(F.lit(NONE))))


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def regions(ident: Column, source: Column, text: Column) -> Column:
    """Regions of a row, sorted; text is title and head together."""
    country = F.regexp_extract(ident, r"\Apat-([a-z]{2})", 1)
    patent = F.when(country != "", F.coalesce(_lookup(PATENT_REGION, country), F.lit("Global")))
    said = let(fold(F.substring(text, 1, 600)), lambda folded: F.array(*[F.when(matches(folded, p), k) for k, p in TEXT_REGION.items()]))
    found = F.concat(F.array(_lookup(SOURCE_REGION, F.coalesce(source, F.lit(""))), patent), said)
    keys = F.array_sort(F.array_distinct(F.array_compact(found)))
    return let(keys, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(F.lit(UNMAPPED))))


def language(text: Column) -> Column:
    """Script first; then votes, in which another language must clearly outvote English."""
    words = F.split(fold(F.substring(text, 1, 3000)), r"[^\p{L}\p{N}_]+")
    voters = F.filter(words, _among(sorted({w for some in LANGUAGE_WORDS.values() for w in some})))  # most words are none
    return let(F.struct(text.alias("text"), voters.alias("words")), lambda x: let(_votes(x["words"]), lambda votes: _language(x["text"], votes)))


def _votes(words: Column) -> Column:
    return F.struct(*[F.size(F.filter(words, _among(w))).alias(k) for k, w in LANGUAGE_WORDS.items()])


def _among(words: list[str]):
    return lambda x: x.isin(words)


def _language(text: Column, counted: Column) -> Column:
    start = F.substring(text, 1, 2000)
    votes = {k: counted[k] for k in LANGUAGE_WORDS}
    best = F.greatest(*votes.values())
    first = reduce(lambda rest, k: F.when(votes[k] == best, k).otherwise(rest), reversed(list(votes)), F.lit("en"))
    voted = F.when((first != "en") & (best > votes["en"] * LANGUAGE_MARGIN), first).otherwise("en")
    return (
        F.when(text.rlike("[가-힯]"), "ko")
        .when(text.rlike("[぀-ヿ]"), "ja")
        .when(chars_in(start, "一-鿿") > 20, "zh")
        .when(chars_in(start, "а-яА-Я") > 20, "ru")
        .otherwise(voted)
    )


def head(text: Column) -> Column:
    return F.substring(body(F.substring(F.coalesce(text, F.lit("")), 1, HEAD_CHARS + 400)), 1, HEAD_CHARS)


def classified(rows: DataFrame) -> DataFrame:
    """id, license, tok, one array of keys for each dimension. rows: id, title, source, license, text_chars, body."""
    seen = rows.withColumn("_text", F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), head(F.col("body")))).withColumn("_folded", fold(F.col("_text")))
    dims = {name: facet(rules, F.col("_folded")) for name, rules in FACETS.items()}
    dims["region"] = regions(F.col("id"), F.col("source"), F.col("_text"))
    dims["language"] = F.array(language(F.col("_text")))
    dims["license"] = F.array(F.coalesce("license", F.lit("unknown")))
    return seen.select("id", tokens(F.coalesce("text_chars", F.lit(0))).alias("tok"), *[c.alias(f"dim_{n}") for n, c in dims.items()])


def marginals(rows: DataFrame) -> DataFrame:
    """dimension, key, docs, tok, gap: below one per cent of all documents and not the placeholder."""
    seen = classified(rows)
    names = [c[4:] for c in seen.columns if c.startswith("dim_")]
    cells = F.flatten(F.array(*[F.transform(f"dim_{n}", _pair(n)) for n in names]))
    out = seen.select("tok", F.explode(cells).alias("cell")).groupBy("cell.dimension", "cell.key").agg(F.count("*").alias("docs"), F.sum("tok").cast("long").alias("tok"))
    # every document has one language; the window runs over as many rows as there are keys
    n = F.sum(F.when(F.col("dimension") == "language", F.col("docs"))).over(Window.partitionBy())
    return out.select("dimension", "key", "docs", "tok", ((F.col("docs") < 0.01 * n) & (F.col("key") != NONE)).alias("gap"))


def _pair(name: str):
    return lambda key: F.struct(F.lit(name).alias("dimension"), key.alias("key"))


def _crossed(rows: DataFrame, other: str, keys: list[str]) -> DataFrame:
    """domain (null: all documents), n (its documents) and a column of document counts for each key."""
    seen = classified(rows).select(F.explode(F.concat(F.array(F.lit(None).cast("string")), "dim_domain")).alias("domain"), F.col(f"dim_{other}").alias("others"))
    return seen.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.array_contains("others", k)).alias(k) for k in keys])


def cross_table(rows: DataFrame, other: str, keys: list[str]) -> DataFrame:
    """domain by another dimension: one column of document counts for each key; no placeholder row."""
    return _crossed(rows, other, keys).where(F.col("domain") != NONE).drop("n")


def cross_cells(rows: DataFrame, other: str, keys: list[str]) -> DataFrame:
    """The table's cells: domain, key, docs, gap (below 0.3 per cent of all documents, yet not empty)."""
    table = _crossed(rows, other, keys)
    # a window over as many rows as there are domains
    table = table.withColumn("all", F.max(F.when(F.col("domain").isNull(), F.col("n"))).over(Window.partitionBy()))
    cells = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"`{k}`").alias("docs"), ((F.col(f"`{k}`") > 0) & (F.col(f"`{k}`") < 0.003 * F.col("all"))).alias("gap")) for k in keys])
    return table.where(F.col("domain") != NONE).select("domain", F.inline(cells))


def genre(source: Column) -> Column:
    """Genre of a source: the exact name, then the first fitting beginning; else null."""
    out = F.lit(None).cast("string")
    for prefixes, name in reversed(PREFIX_GENRE):
        fits = reduce(lambda a, b: a | b, [source.startswith(p) for p in prefixes])
        out = F.when(fits, name).otherwise(out)
    return F.coalesce(_lookup(SOURCE_GENRE, source), out)


def band(n: Column) -> Column:
    return F.when(n == 0, "none").when(n < 16, "thin").when(n < 61, "some").otherwise("heavy")


def genre_coverage(manifest: DataFrame) -> DataFrame:
    """genre, docs, status, place: every genre, gaps first. manifest: source, status."""
    counts = manifest.where("status = 'ok'").groupBy("source").agg(F.count("*").alias("n")).groupBy(genre(F.coalesce("source", F.lit(""))).alias("genre")).agg(F.sum("n").alias("docs"))
    every = manifest.sparkSession.createDataFrame([(g, i) for i, g in enumerate(GENRES)], "genre string, listed int")
    joined = F.broadcast(every).join(counts, "genre", "left").withColumn("docs", F.coalesce("docs", F.lit(0)).cast("long"))
    order = Window.orderBy(F.col("docs") >= 16, F.col("docs") >= 61, "docs", "listed")  # thirteen rows
    return joined.select("genre", "docs", band(F.col("docs")).alias("status"), F.row_number().over(order).alias("place"))


def uncategorized(manifest: DataFrame) -> DataFrame:
    """source, docs of ok rows without a genre."""
    rows = manifest.where("status = 'ok'").groupBy("source").agg(F.count("*").alias("docs"))
    return rows.where(genre(F.coalesce("source", F.lit(""))).isNull())
