"""Discovery helpers shared by connectors: predicates, topic and license rules, candidate shaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import fold, host, java, norm, slug, strip

# Hosts that serve documents directly.
DIRECT_HOSTS = ["arxiv.org", ".gov", "escholarship.org", "ncbi.nlm.nih.gov", "europepmc.org", "mdpi.com", "plos.org", "frontiersin.org", "biomedcentral.com"]
PERMISSIVE = ["cc-by", "cc-by-sa", "cc0", "public-domain"]
# Files of repositories that are never taken.
SKIPPED_NAMES = ["license", "license.md", "license.txt", "license.rst", "copying", "code_of_conduct.md", "contributing.md", "contributing.rst", "changelog.md", "changelog.rst", "security.md", "authors.md"]
SKIPPED_FOLDERS = ["/.github/", "/node_modules/", "/test/", "/tests/", "/vendor/", "/third_party/", "/examples/", "/example/"]
SKIPPED_EXTENSIONS = r"\.(pdf|zip|png|jpe?g|gif|svg|js|css|woff2?|ico|tar|gz|whl|epub|json|xml)\z"
CATALOG_TITLE = r"catalog|catalogue|price.?book|price list|tables of"
# Operational paperwork by document type and by title.
JUNK_TYPE = r"procurement plan|disbursement|agreement|auditing document|audit report|agenda|month(ly)? operational summary|statement of loans|notice|contract|invitation|letter|memorandum of the president|chairman summary|board summary"
JUNK_TITLE = r"procurement plan|disbursement|audit(ed)? report"
# Titles of public documents that are on the subject.
PUBLIC_TITLE = (
    r"\b(?:buildings?|built environment|construction|architectur(?:e|al)|housing|dwellings?|residential|landlords?|mortgage|"
    r"energy (?:efficien|performance|consumption|saving)|decarbonis|retrofit|insulat|"
    r"energy company obligation|display energy certificates?|digest of uk energy statistics|"
    r"heat pumps?|heat networks?|district heat|heating|cooling|ventilat|overheating|boilers?|fuel poverty|smart meters?|"
    r"building regulations?|approved documents?|standard assessment procedure|future homes standard|decent homes standard|cladding|"
    r"development sites?|sites? for development|site (?:assessment|allocation)|land quality|land use|brownfield|town planning|local plans?|"
    r"air mobility|transport|railways?|road (?:construction|maintenance|network|scheme|design)|bridges?|tunnels?|pavements?|tactile paving|"
    r"canals?|waterways?|water (?:supply|resources?|pollution|networks?|infrastructure|code)|sewerage|wastewater|drainage|flood|river restoration|coastal|"
    r"fire(?: and rescue)?|concrete|cement|masonry|structural|geotechnical|asphalt|construction materials?|construction and demolition waste|"
    r"urban environment|urban planning|public realm)\b|\b(?:sap|rdsap|epcs?|esos)\b"
)
QUOTA_ERROR = r"quota|rate.?limit|usage limit|too many requests|429|overloaded"

# Topic rules of the sources, first match wins; the last entry is the default.
TOPIC_RULES: dict[str, list[tuple[str, str | None]]] = {
    "kitopen": [(r"energie|wärme|heiz", "building_energy"), (r"beton|holz|baustoff|werkstoff", "materials"), (r"stadt|urban|quartier", "urban"), (r"brücke|tunnel|tragwerk|seismic|erdbeben", "structures_civil"), (r"klima|lüftung|hvac", "equipment_systems"), ("", "structures_civil")],
    "purdue": [(r"fault|fdd|diagnos|commission", "commissioning_fdd"), (r"control|mpc|bas\b|automation", "controls_bas"), ("", None)],
    "worldbank": [(r"urban|city|cities|municipal", "urban"), (r"district heat|heat pump|cooling|heating|boiler|chiller|appliance", "equipment_systems"), (r"code|standard|regulation|certification|labell?ing", "standards_protocols"), (r"cement|concrete|material|brick|timber", "materials"), (r"construction|housing|building sector", "construction"), (r"grid|transmission|infrastructure|road|transport", "infrastructure"), ("", "building_energy")],
    "patents": [(r"heat pump|heating|ventilat|air condition|\bhvac\b|refrigerat|boiler|furnace|chiller|elevator|escalator|smoke damper|plumbing", "equipment_systems"), (r"thermostat|insulat|solar collector|photovoltaic roof", "building_energy"), (r"formwork|scaffold|prefabricat|drywall|\bconstruction\b|\bbuilding\b", "construction"), (r"concrete|masonry", "materials"), (r"foundation|\bpile\b|girder|truss|bridge|tunnel", "structures_civil"), (r"pavement|asphalt|sewer|drainage", "infrastructure"), (r"\broof\b|facade|window frame|curtain wall|fire sprinkler", "architecture"), ("", None)],
    "ademe": [(r"isolation|rénovation|thermique|énergétique|chauffage", "building_energy"), (r"pompe.{0,3}chaleur|ventilation|climatisation|brasseur", "equipment_systems"), (r"urbanisme|\bville\b|quartier|territoire", "urban"), (r"béton|matériaux|\bbois\b", "materials"), (r"réseau.{0,3}chaleur", "equipment_systems"), ("", "building_energy")],
    "sdz": [(r"sanierung|d[äa]mm|fassade", "building_energy"), (r"quartier|stadt|urban", "urban"), (r"bim|digital", "construction"), (r"speicher|w[äa]rmepumpe|anergie|netz", "equipment_systems"), (r"holz|beton|baustoff", "materials"), ("", "building_energy")],
    "ibpsa": [(r"control|commissioning|automation|\bbas\b|fault detection|\bfdd\b", "controls_bas"), ("", "building_energy")],
    "iea": [(r"heat-pump|cooling|heating|air-condition|appliance|lighting|cooking|cookstove", "equipment_systems"), (r"cement|material", "materials"), (r"city|cities|urban|district", "urban"), (r"grid|demand-response|demand-side|digitali", "controls_bas"), (r"construction", "construction"), (r"standard|certification|labelling", "standards_protocols"), ("", "building_energy")],
    "boverket": [(r"energi|klimatdeklaration|laddinfrastruktur|värme", "building_energy"), (r"byggregler|\bbbr\b|\beks\b|föreskrift|konstruktionsregler", "standards_protocols"), (r"brand", "architecture"), (r"konstruktion|bärverk|bärande", "structures_civil"), (r"plan(ering)?|översiktsplan|detaljplan|stadsutveckling", "urban"), (r"bygg|renovering|ombyggnad", "construction"), ("", "urban")],
    "japan": [("耐震|構造|地震", "structures_civil"), ("火災|防火", "architecture"), ("空調|設備|換気", "equipment_systems"), ("材料|コンクリート|木造", "materials"), ("都市", "urban"), ("", "building_energy")],
    "modelica": [(r"building|hvac|heat pump|district heat|thermal comfort|energyplus|spawn|boptest|ventilation|chiller|boiler", "building_energy"), (r"control|mpc|fmi|co-simulation|cosimulation|real-time|hardware-in-the-loop", "controls_bas"), ("", "equipment_systems")],
}
PURDUE_SERIES = {"icec": "equipment_systems", "iracc": "equipment_systems", "ihpbc": "building_energy"}


def topic(source: str, text: Column) -> Column:
    """Topic of a title (or address) by a source's rules; null where the rules have no default."""
    folded = fold(F.coalesce(text, F.lit("")))
    out = F.lit(None).cast("string")
    for pattern, name in reversed(TOPIC_RULES[source]):
        if name is not None:
            out = F.when(folded.rlike("(?d)" + java(pattern)), name).otherwise(out) if pattern else F.lit(name)
    return out


def downloadable(url: Column) -> Column:
    name = host(url)
    out = F.lit(False)
    for part in DIRECT_HOSTS:
        out = out | name.contains(part)
    return out


def title_relevant(title: Column) -> Column:
    return fold(F.coalesce(title, F.lit(""))).rlike(java(PUBLIC_TITLE))


def trade_catalog(title: Column) -> Column:
    return fold(title).rlike("(?d)" + CATALOG_TITLE)


def junk_document(kind: Column, title: Column) -> Column:
    return fold(F.coalesce(kind, F.lit(""))).rlike(JUNK_TYPE) | fold(title).rlike(JUNK_TITLE)


def wanted_path(path: Column, include: Column, code: Column) -> Column:
    """Whether a repository's file is wanted. include and code are arrays: path beginnings, extensions."""
    low = F.concat(F.lit("/"), F.lower(path))
    base = F.element_at(F.split(low, "/"), -1)
    extension = F.when(base.contains("."), F.element_at(F.split(base, r"\."), -1)).otherwise("")
    prose = extension.isin("md", "rst")
    source = F.array_contains(F.coalesce(code, F.array().cast("array<string>")), extension)
    skipped = F.lit(False)
    for folder in SKIPPED_FOLDERS:
        skipped = skipped | low.contains(folder)
    asked = F.coalesce(include, F.array().cast("array<string>"))
    inside = (F.size(asked) == 0) | F.exists(asked, lambda p: path.startswith(p)) | base.startswith("readme")
    documentation = base.startswith("readme") | low.contains("/doc/") | low.contains("/docs/") | ~path.contains("/")
    return (prose | source) & ~skipped & ~base.isin(SKIPPED_NAMES) & inside & (source | documentation)


def crawlable(url: Column, site: Column, prefix: Column) -> Column:
    """Whether a crawl follows a link: same host, path beginning, no file of a skipped kind."""
    path = F.regexp_extract(url, r"\A[^:]+://[^/?#]*([^?#]*)", 1)
    return (host(url) == site) & ((F.coalesce(prefix, F.lit("")) == "") | path.startswith(prefix)) & ~F.lower(path).rlike(SKIPPED_EXTENSIONS)


def quota_error(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit(""))).rlike(QUOTA_ERROR)


# --- licenses ------------------------------------------------------------------------------------


def license_of_id(ident: Column) -> Column:
    """Tag of a license id like cc-by-4.0; null for what may not be passed on."""
    low = F.lower(F.coalesce(ident, F.lit("")))
    return (
        F.when(low.startswith("cc-by-nc") | low.startswith("cc-by-nd"), None)
        .when(low.startswith("cc-by-sa"), "cc-by-sa")
        .when(low.startswith("cc-by"), "cc-by")
        .when(low.startswith("cc0") | low.contains("public-domain") | low.contains("publicdomain"), "cc0")
    )


def license_of_rights(rights: Column) -> Column:
    """Tag of an array of rights statements by the addresses in them; null otherwise."""
    blob = F.lower(F.array_join(rights, " "))
    return (
        F.when(blob.contains("creativecommons.org/publicdomain/zero"), "cc0")
        .when(blob.contains("creativecommons.org/licenses/by-sa/"), "cc-by-sa")
        .when(blob.contains("creativecommons.org/licenses/by/"), "cc-by")
    )


def license_of_record(page: Column) -> Column:
    """Tag of a whole record by every license address in it; one restricted address rules it out."""
    codes = F.regexp_extract_all(page, F.lit(r"creativecommons\.org/licenses/([a-z-]+)"), F.lit(1))
    restricted = F.exists(codes, lambda c: c.contains("nc") | c.contains("nd"))
    return (
        F.when(page.contains("creativecommons.org/publicdomain/zero"), "cc0")
        .when((F.size(codes) == 0) | restricted, None)
        .when(F.array_contains(codes, "by-sa"), "cc-by-sa")
        .when(F.array_contains(codes, "by"), "cc-by")
    )


def permissive_or_open(license_: Column) -> Column:
    low = F.lower(F.coalesce(license_, F.lit("")))
    return F.when(low.isin(PERMISSIVE), low).otherwise("open")


# --- shaping -------------------------------------------------------------------------------------


def shaped(rows: DataFrame, prefix: str, source: str, size: int = 52, fmt: str = "pdf", title_size: int = 150, id_text: Column | None = None) -> DataFrame:
    """Registry entries of rows with title, url, license, topic (and pos); rows lacking one are dropped."""
    rows = rows.where("coalesce(title, '') <> '' and coalesce(url, '') <> '' and topic is not null and license is not null")
    ident = F.concat(F.lit(prefix), F.substring(slug(F.col("title") if id_text is None else id_text), 1, size))
    extra = ["pos"] if "pos" in rows.columns else []
    return rows.select(ident.alias("id"), F.substring(strip(F.col("title")), 1, title_size).alias("title"), "url", F.lit(source).alias("source"), "license", "topic", F.lit(fmt).alias("format"), *extra)


def composed_title(page: Column, part: Column) -> Column:
    """Page and attachment title together where they differ."""
    different = (F.coalesce(part, F.lit("")) != "") & (norm(part) != norm(page))
    return F.when(different, F.concat(page, F.lit(" — "), part)).otherwise(F.when(F.coalesce(page, F.lit("")) != "", page).otherwise(part))


def unescaped(text: Column) -> Column:
    """The common entities resolved, the ampersand last."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
