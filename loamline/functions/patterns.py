"""Vocabularies and shapes as data, and the patterns made from them."""

from __future__ import annotations

from collections import defaultdict

from loamline.functions.text import WORD

# Stems of the subject vocabulary, by language. A leading or trailing ~ is a word
# boundary. Order matters where one stem begins another.
ENGLISH_STEMS = (
    "build hvac energy thermal heat cool ventil chiller boiler refriger damper ahu vav setpoint "
    "occupan comfort retrofit envelope commission controller sensor actuator bacnet ashrae kwh "
    "carbon emission psychrometr economizer fault diagnos efficien insulat "
    "modelica energyplus openstudio "
    "struct concret cement reinforc rebar masonr timber lumber steel weld beam column "
    "truss girder slab foundation footing bearing geotech soil slope retain excavat "
    "settlement tunnel bridge deck abutment pavement asphalt aggregat seismic earthquake "
    "deflection modulus stress strain shear bending axial construct contractor scaffold "
    "formwork demolition renovat estimat architect facade roof floor durab corros "
    "fatigue fracture composite civil infrastructur survey geomat ~bim~ ~ifc~ hydraul "
    "drainag culvert fire egress sprinkler smoke osha material coating polymer elastic "
    "plastic urban zoning transport highway traffic wastewater geolog hazard flood "
    "coastal levee"
).split()
EUROPEAN_STEMS = [
    *"gebäude bauwesen baustoff beton heizung lüftung dämmung tragwerk brandschutz mauerwerk stahlbau holzbau energieeffizien wärme bauteil".split(),
    *"bâtiment chauffage climatisation".split(), "génie civil", *"charpente maçonnerie béton isolation".split(),
    *"edificio edifício hormigón concreto calefacción construcción construção estructura estrutura albañiler cimentación edilizia calcestruzzo riscaldamento impianti muratura".split(),
    *"gebouw verwarming bouwkunde byggnad uppvärmning bygning rakennus".split(),
    *"~bygg bostad bostäder planering detaljplan översiktsplan fastighet isolering fjärrvärme solcell inomhusmiljö stomme brandskydd ~fukt renover stadsplan infrastruktur energieffektiv klimatdeklaration bolig oppvarming opvarmning ~brann byggeforskrift".split(),
]
CYRILLIC_STEMS = "здани бетон отоплен вентиляц строительств фундамент теплоснабжен конструкци".split()
EAST_ASIAN_STEMS = (
    "建筑 建築 结构 構造 混凝土 钢筋 鋼筋 暖通 空调 空調 供热 供暖 采暖 通风 換気 通風 "
    "节能 節能 省エネ 保温 保溫 断熱 隔热 锅炉 鍋爐 制冷 製冷 冷凍 桥梁 橋梁 隧道 "
    "钢结构 鋼結構 鉄骨 抗震 耐震 岩土 地基 施工 工程 造价 给排水 排水 市政 城市规划 "
    "都市計画 コンクリート 建材 건축 구조 공조 난방 단열 콘크리트"
).split()
ENGLISH_WORDS = "the and of to in is for that with are this be as by on from".split()
# Han, Han extension A, kana, hangul.
CJK = "一-鿿㐀-䶿぀-ヿ가-힯"


def _bounded(stem: str, before: str, after: str) -> str:
    return (before if stem.startswith("~") else "") + stem.strip("~") + (after if stem.endswith("~") else "")


def subject_stems() -> list[str]:
    return [*ENGLISH_STEMS, *EUROPEAN_STEMS, *CYRILLIC_STEMS, *EAST_ASIAN_STEMS]


def subject_pattern(stems: list[str] | None = None) -> str:
    """The vocabulary for folded text, grouped by first letter.

    Stems of different first letters exclude each other, so grouping leaves the leftmost match and
    its length as they are; a look-ahead on first letters spares most positions the alternation.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for stem in subject_stems() if stems is None else stems:
        groups[stem.strip("~")[0]].append(stem)
    parts = {}
    for first, some in sorted(groups.items()):
        rests = [("(?<!" + WORD + first + ")" if s.startswith("~") else "") + s.strip("~")[1:] + (f"(?!{WORD})" if s.endswith("~") else "") for s in some]
        parts[first] = f"{first}(?:{'|'.join(rests)})"
    # classes of ASCII letters are bit sets in the JVM; other letters share one block behind them
    letters = [x for x in parts if x < "\x7f"]
    blocks = [letters[i : i + 5] for i in range(0, len(letters), 5)]
    inner = [f"(?=[{''.join(b)}])(?:{'|'.join(parts[x] for x in b)})" for b in blocks]
    if others := [p for x, p in parts.items() if x not in letters]:
        inner.append(rf"(?=[^\x00-\x7f])(?:{'|'.join(others)})")
    return rf"(?:(?=[{''.join(letters)}])|(?=[^\x00-\x7f]))(?:{'|'.join(inner)})"


def subject_re2(stems: list[str] | None = None) -> str:
    """The same for RE2, whose word boundary knows ASCII only."""
    return "(?i)" + "|".join(_bounded(s, r"\b", r"\b") for s in (subject_stems() if stems is None else stems))


def words_pattern(words: list[str]) -> str:
    firsts = "".join(sorted({w[0] for w in words}))
    return f"(?=[{firsts}])(?<!{WORD})(?:{'|'.join(words)})(?!{WORD})"


# Patent titles that are off the subject whatever else they say; those that are unless
# the guard matches; the guard.
TITLE_KILL_HARD = r"electronic cigarette|e-cigarette|smoking article|nicotine"
TITLE_KILL = (
    r"transistor|semiconductor|field[- ]effect|insulated[- ]gate bipolar|\bwafer\b|"
    r"photolithograph|integrated circuit|memory cell|\bdram\b|\bcmos\b|\bmosfet\b|\bigbt\b|"
    r"silicon[- ]on[- ]insulator|epitaxial|atomizer|"
    r"magnetic tunnel|tunnel junction|tunnel(?:ing)? (?:junction|magnetoresist|barrier|diode)|"
    r"quantum tunnel|bridge (?:circuit|rectifier)|wheatstone|dental bridge|"
    r"pile fabric|pile yarn|carpet pile|"
    r"(?:cosmetic|makeup|make-up).{0,30}foundation|foundation.{0,30}(?:cosmetic|makeup|concealer)|"
    r"construction of (?:a )?(?:point cloud|data|image|gene|genome|dna|plasmid|genetic)"
)
TITLE_GUARD = (
    r"wafer ?board|ventilat|dehumidif|heat pump|air.?condition|\bhvac\b|chiller|refrigerat|"
    r"formwork|concrete|masonry|girder|abutment|asphalt|pavement|curtain wall"
)
