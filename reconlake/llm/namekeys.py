"""Keys of typed facility names and addresses: parts, sound and place.

A name is split into legal form with corporation, brand, stem, area words and type words; every spelling
(kanji, kana, Latin letters, old forms of kanji) is brought to one rough sound in which voicing and vowel length
are left out, so that spellings by ear meet. An address is split into prefecture, municipality, quarter and numbers.

How kanji are read is learned from the records themselves (readings.py); common readings hold where they teach none. Which Latin words are brands is told by the records as well (names.py).
"""

from __future__ import annotations

import re
import unicodedata

from reconlake.llm.canon import canonical

# --- fixed values: common readings of kanji, two-character words first; they hold where the records teach none ---
READINGS = dict(x.split(":") for x in (
    "琥珀:こはく 百合:ゆり 福寿:ふくじゅ 石蕗:つわぶき 長閑:のどか 織部:おりべ 若葉:わかば 千草:ちぐさ 高砂:たかさご 常盤:ときわ "
    "羽衣:はごろも 丹波:たんば 八雲:やくも 牡丹:ぼたん 神楽:かぐら 三峰:みみね 水無:みずなし 一色:いっしき 二葉:ふたば 瑠璃:るり "
    "馬場:ばば 金木:かねき 清水:しみず 汐見:しおみ 朝日:あさひ 夕映:ゆうばえ "
    "通り:とおり 駅前:えきまえ 東口:ひがしぐち 西口:にしぐち 南口:みなみぐち 北口:きたぐち 本町:ほんまち 新町:しんまち 元町:もとまち "
    "広場:ひろば 団地:だんち 公園:こうえん 高台:たかだい 並木:なみき 第一:だいいち 第二:だいに 第三:だいさん 中央:ちゅうおう "
    "大橋:おおはし 緑地:りょくち 河岸:かし "
    "上:かみ 下:しも 大:おお 小:こ 新:しん 東:ひがし 西:にし 南:みなみ 北:きた 港:みなと "
    "光:ひかり 葵:あおい 蒼:あお 青:あお 茜:あかね 曙:あけぼの 暁:あかつき 綾:あや 杏:あんず 磯:いそ 泉:いずみ 兎:うさぎ 梅:うめ 潮:うしお "
    "柿:かき 櫂:かい 楓:かえで 風:かぜ 霞:かすみ 桂:かつら 亀:かめ 貝:かい 雁:かり 菊:きく 狐:きつね 絹:きぬ 桐:きり 霧:きり 栗:くり 雲:くも 桜:さくら 鷺:さぎ "
    "鹿:しか 白:しろ 菫:すみれ 杉:すぎ 鈴:すず 砂:すな 芹:せり 滝:たき 竹:たけ 月:つき 椿:つばき 燕:つばめ 鶴:つる 虹:にじ 錦:にしき "
    "萩:はぎ 蓮:はす 鳩:はと 花:はな 浜:はま 藤:ふじ 星:ほし 蛍:ほたる 帆:ほ 松:まつ 翠:みどり 緑:みどり 桃:もも 森:もり 柳:やなぎ 雪:ゆき "
    "根:ね 見:み 石:いし 橋:はし 木:き 宮:みや 屋:や 岬:みさき 牧:まき 寺:てら 津:つ 井:い 戸:ど 丘:おか 枝:えだ 岩:いわ 窪:くぼ 池:いけ 城:しろ 堀:ほり 賀:が "
    "山:やま 平:だいら 林:はやし 尾:お 畑:はた 里:さと 越:こし 方:かた 岡:おか 江:え 川:かわ 沼:ぬま 野:の 渕:ふち 田:た 坂:さか 瀬:せ 門:かど 辺:べ 峠:とうげ "
    "塚:つか 原:はら 島:しま 垣:かき 倉:くら 沢:さわ 谷:たに 浦:うら 崎:さき 場:ば 本:もと 町:まち 葉:は 台:だい 園:その 峰:みね 地:ち 口:くち"
).split())
# old or variant kanji and the form in common use
VARIANTS = str.maketrans("瀧嶋埜澤邊嵜圓櫻濱櫂峯籐眞髙﨑阪", "滝島野沢辺崎園桜浜櫂峰藤真高崎坂")
LEGAL = re.compile(r"(?:社会|特定)?医療法人(?:社団|財団)?|一般社団法人|一般財団法人|\(医\)|（医）|医\)|医）|\(社医\)")
CORPORATION = re.compile(r"(?:[一-鿿]{2}(?:正|新|仁|愛)?会)(?=[ 　]|[^院]|$)")
#: a Latin word that can be Japanese in Latin letters; others before a name may be brands
ROMANISED = re.compile(
    r"(?:(?:[kstnhmrgzdbpfjwy]|ch|sh|ts|[kgnhbpmr]y)?[aiueoāīūēō]|n(?![aiueoy])|k(?=k)|s(?=s)|t(?=[tc])|p(?=p)|m(?=[bpm])|(?<=[aiueo])h(?![aiueoy]))+"
)
# type words: spellings of each kind, longest first
TYPES = (
    ("sports", r"(?:ひざ・)?スポーツ(?:整形外科|整型外科|正形外科|整外|整形)?(?:クリニック)?|(?:hiza )?sports"),
    ("rehab", r"リハビリテーション|リハビリ|リハ|rehabilitation"),
    ("joint", r"関節|joint"),
    ("pain", r"ペイン|pain"),
    ("general", r"総合|総病|general"),
    ("memorial", r"記念|kinen"),
    ("ortho", r"整形外科|整型外科|正形外科|整外|整形|seikei"),
)
_TAIL = re.compile(
    r"本院|クリニック|クリニツク|クリニク|医院|医員|病院|病員|総病|(?<=[一-鿿ぁ-ん])医(?=[ ]|$)|(?<![a-z])(?:clinic|hospital|hosp\.?|iin|cl\.?|hp)(?![a-z])"
)
AREAS = (
    "駅前 東口 西口 南口 北口 本町 新町 元町 広場 団地 公園 高台 並木 第一 第二 第三 中央 大橋 緑地 河岸 通り 東 西 南 北 港"
).split()
PREFECTURES = (
    "北海道 青森県 岩手県 宮城県 秋田県 山形県 福島県 茨城県 栃木県 群馬県 埼玉県 千葉県 東京都 神奈川県 新潟県 富山県 石川県 福井県 "
    "山梨県 長野県 岐阜県 静岡県 愛知県 三重県 滋賀県 京都府 大阪府 兵庫県 奈良県 和歌山県 鳥取県 島根県 岡山県 広島県 山口県 徳島県 "
    "香川県 愛媛県 高知県 福岡県 佐賀県 長崎県 熊本県 大分県 宮崎県 鹿児島県 沖縄県"
).split()

AREA_READINGS = {k: v for k, v in READINGS.items() if k in AREAS}
_LONGEST = max(map(len, READINGS))
_ROMAN = {}
for _row, _c in (("あいうえお", ""), ("かきくけこ", "k"), ("がぎぐげご", "k"), ("さしすせそ", "s"), ("ざじずぜぞ", "s"), ("たちつてと", "t"), ("だぢづでど", "t"),
                 ("なにぬねの", "n"), ("はひふへほ", "h"), ("ばびぶべぼ", "h"), ("ぱぴぷぺぽ", "h"), ("まみむめも", "m"), ("らりるれろ", "r")):
    for _k, _v in zip(_row, "aiueo", strict=True):
        _ROMAN[_k] = _c + _v
_ROMAN |= {"や": "a", "ゆ": "u", "よ": "o", "わ": "a", "を": "o", "ん": "n", "っ": "", "ー": "", "ゃ": "\x00a", "ゅ": "\x00u", "ょ": "\x00o"}


def _hiragana(text: str) -> str:
    return "".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in text)


def rough(text: str) -> str:
    """Kana and Latin letters in one rough Latin spelling without voicing; kanji stay as they are."""
    out = _hiragana(text).lower()
    s = "".join(_ROMAN.get(c, c) for c in out)
    s = re.sub(r"[aiueo]\x00", "", s)
    s = unicodedata.normalize("NFKD", s)
    s = "".join(c for c in s if not unicodedata.combining(c))
    # Latin spellings
    s = re.sub(r"m(?=[bpm])", "n", s) if re.search("[a-z]", text.lower()) else s
    for a, b in (("tch", "t"), ("sh", "s"), ("ch", "t"), ("ts", "t"), ("j", "s"), ("z", "s"), ("g", "k"), ("d", "t"), ("b", "h"), ("p", "h"), ("f", "h"), ("w", ""), ("c", "k")):
        s = s.replace(a, b)
    return s.replace("y", "")


def flat(s: str) -> str:
    """A rough spelling without long vowels and double letters."""
    s = re.sub(r"o[ou]", "o", s)
    s = re.sub(r"([aiueo])\1+", r"\1", s)
    s = re.sub(r"([^aiueo])\1+", r"\1", s)
    return re.sub(r"[^a-z0-9一-鿿]", "", s)


def sound(text: str, learned: dict[str, str] | None = None) -> str:
    """Rough sound of a name part in Latin letters; kanji without a reading stay as they are.

    learned maps kanji to rough readings, which go before the common ones.
    """
    out, i = "", 0
    text = text.translate(VARIANTS).replace("さんの", "の")
    while i < len(text):
        for n in range(_LONGEST, 0, -1):
            if n == 1 and learned and text[i] in learned:
                out += learned[text[i]]
                i += 1
                break
            if text[i : i + n] in READINGS:
                out += READINGS[text[i : i + n]]
                i += n
                break
        else:
            out += text[i]
            i += 1
    s = rough(out)
    s = s.replace("no", "") or s  # the particle, and in every spelling alike whatever sounds like it
    return flat(s)


_AREA_SOUNDS = sorted(((sound(a), a) for a in AREAS if len(sound(a)) >= 3), key=lambda p: -len(p[0]))


def foreign_words(name: str | None) -> list[str]:
    """The Latin words of a name that are neither type words nor Japanese in Latin letters: its possible brands."""
    t = re.sub(r"(?<=[a-z])[.]", " ", LEGAL.sub(" ", canonical(name or "")).lower())
    for _, pattern in TYPES:
        t = re.sub(pattern, " ", t)
    words = re.findall(r"[a-z\u00df-\u024f]+", _TAIL.sub(" ", t))
    return sorted({w for w in words if len(w) >= 2 and not ROMANISED.fullmatch(w)})


def split_name(name: str | None, brands: frozenset[str] = frozenset()) -> tuple[str, str, str, str, str]:
    """(corporation, brand, stem, area, types) of a typed name; the stem holds the area word, brands only words of the given set."""
    t = canonical(name or "")
    t = re.sub(r"(?<=[ァ-ヺー])ニツク", "ニック", t)
    corp = ""
    t, had = LEGAL.subn(" ", t)
    m = CORPORATION.search(t)
    if m and (had or len(m[0]) in (3, 4)):
        corp = m[0]
        t = t[: m.start()] + " " + t[m.end() :]
    t = t.lower().translate(VARIANTS)
    brand: list[str] = []
    if brands:
        t = re.sub(r"[a-z\u00df-\u024f]+", lambda m: brand.append(m[0]) or " " if m[0] in brands else m[0], t)
    types = []
    for kind, pattern in TYPES:
        t, n = re.subn(pattern, " ", t)
        if n:
            types.append(kind)
    house = ""
    for m in _TAIL.finditer(t):
        w = m[0]
        house = "hospital" if w[:2] in ("病院", "病員", "ho", "hp", "総病") else "clinic"
    t = _TAIL.sub(" ", t)
    t = re.sub(r"(?<=[a-z])[.]", " ", t)
    stem = "".join(t.split())
    if not stem and brand:  # a name of nothing but such words is its own stem
        stem, brand = "".join(brand), []
    area = ""
    for a in AREAS:
        if stem.endswith(a) and len(stem) > len(a):
            area = a
            break
    if not area:
        s = sound(stem)
        for x, a in _AREA_SOUNDS:
            if s.endswith(x) and len(s) > len(x) + 2:
                area = a
                break
    return corp, " ".join(brand), stem, area, "+".join(types + [house] if house else types)


def name_parts(name: str | None, brands: frozenset[str] = frozenset(), learned: dict[str, str] | None = None) -> tuple[str, str, str, str, str, str]:
    """(corporation, brand, sound of stem and area, area, types, kanji of the stem) of a typed name."""
    corp, brand, stem, area, types = split_name(name, brands)
    return corp, brand, sound(stem, learned), area, types, kanji_of(stem)


def kanji_of(stem: str) -> str:
    return "".join(c for c in stem if "一" <= c <= "鿿")


_DIGIT = {c: i for i, c in enumerate("〇一二三四五六七八九")}


def _kanji_number(m: re.Match) -> str:
    total = cur = 0
    for ch in m[0]:
        if ch in "十百":
            total += (cur or 1) * (10 if ch == "十" else 100)
            cur = 0
        else:
            cur = cur * 10 + _DIGIT[ch]
    return str(total + cur)


_NUMERAL = "[〇一二三四五六七八九十百]+"
_MUNICIPALITY = re.compile(r"^(.{2,6}?[市区町村])")


def address_parts(address: str | None, prefecture: str | None = None) -> tuple[str, str, str, str]:
    """(prefecture, municipality, quarter, numbers joined by '-'); empty where not stated."""
    t = unicodedata.normalize("NFKC", address or "")
    t = re.sub(r"〒?\s*\d{3}-\d{4}", "", t)
    t = "".join(t.split())
    pref = prefecture or ""
    for p in PREFECTURES:
        if t.startswith(p):
            pref, t = p, t[len(p) :]
            break
    t = re.sub(rf"{_NUMERAL}(?=丁目|番地|番|号)", _kanji_number, t)
    t = re.sub(rf"(?<=番地){_NUMERAL}|(?<=番){_NUMERAL}", _kanji_number, t)
    t = re.sub(r"[‐‑–—―−ー](?=\d)", "-", t)
    city = ""
    m = _MUNICIPALITY.match(t)
    if m:
        city, t = m[1], t[m.end() :]
    m = re.search(r"\d+(?:(?:丁目|番地|番|-)の?\d+)*(?:号|番地|番|丁目)?", t)
    numbers = ""
    quarter = t
    if m:
        numbers = "-".join(re.findall(r"\d+", m[0])[:3])
        quarter = t[: m.start()]
    return pref, city.translate(VARIANTS), quarter.translate(VARIANTS), numbers
