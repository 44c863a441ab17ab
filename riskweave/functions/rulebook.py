"""The classification ladders and name lists, in order (first match wins).

Profiling ladders (``EDA_*``) produce display labels; staging ladders (``STG_*``) produce the
lower-case codes the feature table carries.  They differ on purpose and are kept apart.
``_`` in a pattern stands for any one character, so ``10_13`` also covers ``10.13``.
"""

from __future__ import annotations

from .ladders import Except, Ladder, Names

# Rare browsers, exact spelling.
EXOTIC_BROWSERS = (
    "waterfox", "cyberfox", "palemoon", "puffin", "seamonkey", "iron",
    "comodo", "icedragon", "maxthon", "aol", "line",
)

# Operating system family (profiling).
EDA_OS_FAMILY = Ladder(
    (
        ("Windows", ("%windows%",)),
        ("Mac", ("%mac os%", "%mac%")),
        ("iOS", ("%ios%",)),
        ("Android", ("%android%",)),
        ("Linux", ("%linux%",)),
    ),
    if_null="No Identity Match",
    otherwise="Other",
)

# Operating system version (profiling, feature form).
EDA_OS_VERSION = Ladder(
    (
        ("Windows 10", ("%windows 10%",)),
        ("Windows 7", ("%windows 7%",)),
        ("Windows 8/8.1", ("%windows 8%",)),
        ("Windows Vista", ("%windows vista%",)),
        ("Windows XP", ("%windows xp%",)),
        ("macOS High Sierra", ("%mac os x 10_13%",)),
        ("macOS Sierra", ("%mac os x 10_12%",)),
        ("OS X El Capitan", ("%mac os x 10_11%",)),
        ("OS X Yosemite", ("%mac os x 10_10%",)),
        ("OS X Mavericks", ("%mac os x 10_9%",)),
        ("OS X Lion (Old)", ("%mac os x 10_7%",)),
        ("iOS 11", ("%ios 11%",)),
        ("iOS 10", ("%ios 10%",)),
        ("iOS 9 (Old)", ("%ios 9%",)),
        ("Android 8", ("%android 8%",)),
        ("Android 7", ("%android 7%",)),
        ("Android 6", ("%android 6%",)),
        ("Android 5 (Old)", ("%android 5%",)),
        ("Android 4 (Very Old)", ("%android 4%",)),
        ("Linux", ("%linux%",)),
    ),
    if_null="No Identity Match",
    otherwise="Other",
)

# Operating system version (profiling, rate form).
EDA_OS_VERSION_RATE = Ladder(
    (
        ("Windows 7 (Old)", ("%windows 7%",)),
        ("Windows 10", ("%windows 10%",)),
        ("Windows 8/8.1", ("%windows 8%",)),
        ("Windows Vista/XP (Very Old)", ("%windows vista%", "%windows xp%")),
        ("iOS 9 (Old)", ("%ios 9%",)),
        ("iOS 10", ("%ios 10%",)),
        ("iOS 11", ("%ios 11%",)),
        ("Android 4 (Very Old)", ("%android 4%",)),
        ("Android 5 (Old)", ("%android 5%",)),
        ("Android 6", ("%android 6%",)),
        ("Android 7", ("%android 7%",)),
        ("Android 8", ("%android 8%",)),
        ("macOS High Sierra", ("%mac os x 10_13%",)),
        ("macOS Sierra", ("%mac os x 10_12%",)),
        ("macOS El Capitan", ("%mac os x 10_11%",)),
        ("macOS (Other)", ("%mac os%",)),
        ("Linux", ("%linux%",)),
    ),
    if_null="No OS Info",
    otherwise="Other",
)

# Operating system family (staging).
STG_OS_GROUP = Ladder(
    (
        ("windows", ("%windows%",)),
        ("mac", ("%mac os%",)),
        ("ios", ("%ios%",)),
        ("android", ("%android%",)),
        ("linux", ("%linux%",)),
    ),
    if_null="unknown",
    otherwise="other",
)

# Operating system version (staging).
STG_OS_VERSION = Ladder(
    (
        ("windows_10", ("%windows 10%",)),
        ("windows_7_old", ("%windows 7%",)),
        ("windows_8", ("%windows 8%",)),
        ("windows_very_old", ("%windows vista%", "%windows xp%")),
        ("ios_11", ("%ios 11%",)),
        ("ios_10", ("%ios 10%",)),
        ("ios_9_old", ("%ios 9%",)),
        ("android_8", ("%android 8%",)),
        ("android_7", ("%android 7%",)),
        ("android_6", ("%android 6%",)),
        ("android_5_old", ("%android 5%",)),
        ("android_4_very_old", ("%android 4%",)),
        ("macos_high_sierra", ("%mac os x 10_13%",)),
        ("macos_sierra", ("%mac os x 10_12%",)),
        ("macos_el_capitan", ("%mac os x 10_11%",)),
        ("macos_old", ("%mac os%",)),
        ("linux", ("%linux%",)),
    ),
    if_null="unknown",
    otherwise="other",
)

# Browser family (profiling).
EDA_BROWSER_FAMILY = Ladder(
    (
        ("Samsung Browser", ("%samsung browser%",)),
        ("Safari", ("%mobile safari%", "%safari%")),
        ("Chrome Mobile", ("%chrome%for android%", "%chrome%for ios%")),
        ("Chrome", ("%chrome%",)),
        ("Firefox", ("%firefox%",)),
        ("Edge", ("%edge%",)),
        ("IE", ("%ie%",)),
        ("Opera", ("%opera%",)),
        ("WebView", ("%android webview%", "%mobile%uiwebview%")),
        ("Silk (Amazon)", ("%silk%",)),
        ("Exotic/Rare Browser", (Names(EXOTIC_BROWSERS),)),
    ),
    if_null="No Identity Match",
    otherwise="Other",
)

# Browser family (segment dashboard).
DASHBOARD_BROWSER_FAMILY = Ladder(
    (
        ("Samsung Browser", ("%samsung browser%",)),
        ("Safari", ("%mobile safari%", "%safari%")),
        ("Chrome Mobile", ("%chrome%for android%", "%chrome%for ios%")),
        ("Chrome", ("%chrome%",)),
        ("Firefox", ("%firefox%",)),
        ("Edge", ("%edge%",)),
        ("IE", ("%ie%",)),
        ("Opera", ("%opera%",)),
    ),
    if_null="No Identity Match",
    otherwise="Other",
)

# Browser family (staging).
STG_BROWSER_FAMILY = Ladder(
    (
        ("samsung_browser", ("%samsung browser%",)),
        ("safari", ("%mobile safari%", Except("%safari%", unless="%chrome%"))),
        ("chrome_mobile", ("%chrome%for android%", "%chrome%for ios%")),
        ("chrome", ("%chrome%",)),
        ("firefox", ("%firefox%",)),
        ("edge", ("%edge%",)),
        ("ie", ("%ie%",)),
        ("opera", ("%opera%",)),
        ("webview", ("%android webview%", "%uiwebview%")),
        ("silk", ("%silk%",)),
        ("exotic", (Names(EXOTIC_BROWSERS),)),
    ),
    if_null="unknown",
    otherwise="other",
)

# Chrome major version, upper bounds (exclusive) and labels; then the open-ended
# bucket and the label for Chrome without a readable version.
STG_CHROME_BUCKETS = (
    ((55, "chrome_old"), (60, "chrome_55_59"), (65, "chrome_60_64")),
    "chrome_65_plus",
    "chrome_unknown",
)
EDA_CHROME_BUCKETS = (
    ((55, "Chrome < 55 (Old)"), (60, "Chrome 55-59"), (65, "Chrome 60-64")),
    "Chrome 65+",
    "Chrome (version unknown)",
)

# Device manufacturer (profiling, feature form).
EDA_MANUFACTURER = Ladder(
    (
        ("Samsung", ("%SAMSUNG%", "SM-%", "GT-%", "SCH-%")),
        ("Motorola", ("%Moto%", "XT%")),
        ("LG", ("LG-%", "LGL%", "LGMS%", "LGLS%")),
        ("Huawei", ("%HUAWEI%", "%Honor%")),
        ("Xiaomi", ("%Redmi%", "%Xiaomi%", "Mi %")),
        ("Google", ("%Pixel%", "%Nexus%")),
        ("HTC", ("%HTC%",)),
        ("Lenovo", ("%Lenovo%",)),
        ("Nokia", ("%Nokia%", "TA-%")),
        ("ZTE", ("%ZTE%", "%Blade%", "Z%Build%")),
        ("Alcatel", ("%Alcatel%", "%ONE TOUCH%")),
        ("BLU", ("%BLU%",)),
        ("Lanix", ("%Ilium%", "%Lanix%")),
        ("Hisense", ("%Hisense%",)),
        ("OnePlus", ("%ONEPLUS%",)),
        ("Sony", ("%Sony%", "F%Build%", "D%Build%", "E%Build%")),
        ("Amazon Kindle", ("%KFASWI%", "%KFFOWI%", "KF%")),
        ("Desktop/Non-Mobile", ("%Windows%", "%rv:%", "%Trident%", "%WOW64%", "%Linux x86%")),
        ("Apple (iOS)", ("%iOS%",)),
    ),
    if_null="No Identity Match",
    otherwise="Other/Unknown",
)

# Device manufacturer (segment dashboard).
DASHBOARD_MANUFACTURER = Ladder(
    (
        ("Samsung", ("%SAMSUNG%", "SM-%")),
        ("Apple", ("%Apple%", "%iOS%")),
        ("Huawei", ("%Huawei%", "%Honor%")),
        ("Xiaomi", ("%Xiaomi%", "%Redmi%")),
    ),
    if_null="No Identity Match",
    otherwise="Other/Unknown",
)

# Device manufacturer (profiling, rate form).
EDA_MANUFACTURER_RATE = Ladder(
    (
        ("Samsung", ("%SAMSUNG%", "SM-%", "GT-%")),
        ("Motorola", ("%Moto%", "XT%")),
        ("LG", ("LG-%", "LGL%", "LGMS%")),
        ("Huawei", ("%HUAWEI%", "%Honor%")),
        ("Xiaomi", ("%Redmi%", "%Xiaomi%")),
        ("Google", ("%Pixel%", "%Nexus%")),
        ("BLU", ("%BLU%",)),
        ("ZTE", ("%ZTE%", "%Blade%")),
        ("Alcatel", ("%Alcatel%", "%ONE TOUCH%")),
        ("Lenovo", ("%Lenovo%",)),
        ("Nokia", ("TA-%", "%Nokia%")),
        ("Amazon Kindle", ("%KF%",)),
        ("Desktop/Non-Mobile", ("%Windows%", "%rv:%", "%Trident%")),
    ),
    if_null="No Device Info",
    otherwise="Other/Unknown",
)

# Device manufacturer (staging).
STG_MANUFACTURER = Ladder(
    (
        ("samsung", ("%SAMSUNG%", "SM-%", "GT-%", "SCH-%")),
        ("motorola", ("%Moto%", "XT%")),
        ("lg", ("LG-%", "LGL%", "LGMS%", "LGLS%")),
        ("huawei", ("%HUAWEI%", "%Honor%")),
        ("xiaomi", ("%Redmi%", "%Xiaomi%", "Mi %")),
        ("google", ("%Pixel%", "%Nexus%")),
        ("htc", ("%HTC%",)),
        ("lenovo", ("%Lenovo%",)),
        ("nokia", ("TA-%", "%Nokia%")),
        ("zte", ("%ZTE%", "%Blade%")),
        ("alcatel", ("%Alcatel%", "%ONE TOUCH%")),
        ("blu", ("%BLU%",)),
        ("lanix", ("%Ilium%", "%Lanix%")),
        ("amazon_kindle", ("%KF%",)),
        ("desktop_non_mobile", ("%Windows%", "%rv:%", "%Trident%", "%WOW64%", "%Linux x86%")),
    ),
    if_null="unknown",
    otherwise="other",
)

# Samsung price tier (profiling).
EDA_SAMSUNG_TIER = Ladder(
    (
        ("Samsung Flagship (S/Note)", ("SM-G9%", "SM-N9%", "SAMSUNG SM-G9%", "SAMSUNG SM-N9%")),
        ("Samsung Mid-Range (A/J)", ("SM-A%", "SM-J%", "SAMSUNG SM-A%", "SAMSUNG SM-J%")),
        ("Samsung Budget (G3/G5xx)", ("SM-G5%", "SM-G3%", "SAMSUNG SM-G5%", "SAMSUNG SM-G3%")),
    ),
)

# Samsung price tier (staging; the budget arm lacks the prefixed forms).
STG_SAMSUNG_TIER = Ladder(
    (
        ("samsung_flagship", ("SM-G9%", "SM-N9%", "SAMSUNG SM-G9%", "SAMSUNG SM-N9%")),
        ("samsung_mid", ("SM-A%", "SM-J%", "SAMSUNG SM-A%", "SAMSUNG SM-J%")),
        ("samsung_budget", ("SM-G5%", "SM-G3%")),
    ),
)

# E-mail provider group; case matters here.
EMAIL_GROUP = Ladder(
    (
        ("gmail", ("%gmail%",)),
        ("yahoo", ("%yahoo%",)),
        ("outlook", ("%outlook%",)),
        ("hotmail", ("%hotmail%",)),
    ),
    if_null="unknown",
    otherwise="other",
    case_sensitive=True,
)

# Unpatched Android on a budget brand.
OLD_ANDROID = ("%android 4%", "%android 5%")
BUDGET_BRANDS = ("%Nokia%", "%ZTE%", "%BLU%", "%Alcatel%", "%Lanix%")

# Hours (inclusive) and names of the parts of the day.
TIME_BUCKETS = ((0, 5, "high_risk_hours"), (6, 18, "normal_hours"))
TIME_BUCKET_REST = "evening_hours"

# Risk tiers, upper bounds inclusive; a score of exactly 0 has no tier.
RISK_TIERS = ((0.3, "LOW"), (0.6, "MEDIUM"), (0.8, "HIGH"), (1.0, "CRITICAL"))
