"""Fixed values.

Word lists, labels, patterns and limits that must be exactly these for results to be right.
Everything here is data; no logic.
"""

# Portal labels written to `source`, and the landing file name prefix of each portal.
SOURCE_NESTED = "Wuzzuf"
SOURCE_FLAT_A = "Sabbar"
SOURCE_FLAT_B = "Tanqeeb"
FILE_PREFIXES = ["wuzzuf", "sabbar", "tanqeeb"]

# Portal addresses used to make links absolute and to filter hosts.
NESTED_BASE_URL = "https://wuzzuf.net"
FLAT_B_BASE_URL = "https://saudi.tanqeeb.com"
FLAT_B_HOST = "saudi.tanqeeb.com"

# How a posting page carries its state.
STATE_MARKER = "Wuzzuf.initialStoreState"
ESCAPED_MARKER = '\\"jobPositionValue\\"'
ESCAPED_OPENER = '{\\"id\\":'

# Name of postings without a member of a dimension in demand reports.
NO_MEMBER = "(none)"

# Operating limits.
KNOWN_PAGES_NESTED = 9
KNOWN_PAGES_FLAT_B = 80
MAX_PAGES_FLAT_B = 1000
RUN_CAP_FLAT_A = 900
RUN_CAP_NESTED = 150
RUN_CAP_FLAT_B = 100
BATCH_SIZE_FLAT_A = 400
BATCH_SIZE_FLAT_B = 50

# Fetch outcomes that are final.
GONE_STATUSES = [404, 410]
GONE_ERROR = "no_details_extracted"
GONE_REASON = "gone_no_details"

# Defaults.
COUNTRY = "Saudi Arabia"
CURRENCY = "SAR"
NOT_SPECIFIED = "Not Specified"
UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"
PIPELINE_NAME = "silver_to_gold_job_postings"

# Input validation.
EMPTY_WORDS = ["", "n/a", "nan", "none", "null"]
COUNTRY_DENIED = ["", "n/a", "nan", "none", "null", "egypt", "cairo", "us", "usa"]
COUNTRY_PATTERN = "saudi|المملكة|السعودية|ksa"

# Rows outside the scope.
OUT_OF_SCOPE_URL = "jobs-in-egypt"
OUT_OF_SCOPE_CITIES = [
    "Cairo",
    "Cairo - Egypt",
    "Domiat",
    "Kansas",
    "Missouri",
    "Saudi Arabiaunited Arab Emirates - Saudi Arabia",
]

# Keyword -> label, first match wins.
WORK_MODES = [("remote", "Remote"), ("hybrid", "Hybrid"), ("field", "Field")]
WORK_MODE_DEFAULT = "On-site"
EMPLOYMENT_TYPES = [
    ("full", "Full-time"),
    ("part", "Part-time"),
    ("contract", "Contract"),
    ("intern", "Internship"),
    ("freelance", "Freelance"),
]
QUALIFICATIONS = [
    ("بكالوريوس|bachelor|جامعي", "Bachelor's Degree"),
    ("ماجستير|master|دكتوراه", "Master's Degree / PhD"),
    ("دبلوم|diploma", "Diploma"),
    ("ثانوي|high school", "High School"),
]

# Tags on a posting page.
TAG_WORK_MODES = ["on-site", "remote", "hybrid"]
TAG_JOB_TYPES = ["full time", "part time", "contract", "internship", "temporary", "freelance"]

# City words that mean "no city".
CITY_EMPTY_WORDS = ["n/a", "unknown", "none", "", "nan"]

# City spelling (lower case) -> city name.
CITY_NAMES = {
    "الرياض": "Riyadh",
    "رياض": "Riyadh",
    "riyadh": "Riyadh",
    "الدرعية": "Ad Diriyah",
    "ad diriyah": "Ad Diriyah",
    "الخرج": "Al Kharj",
    "al-kharj": "Al Kharj",
    "المجمعة": "Al Majmaah",
    "حوطة سدير": "Hawtat Sudair",
    "ضرما": "Duruma",
    "مرات": "Marat",
    "حريملاء": "Huraymila",
    "الدوادمي": "Ad Duwadimi",
    "الدلم": "Al-Dalm",
    "نفي": "Nifi",
    "جدة": "Jeddah",
    "جده": "Jeddah",
    "jeddah": "Jeddah",
    "مكة": "Makkah",
    "مكة المكرمة": "Makkah",
    "مكه": "Makkah",
    "mecca": "Makkah",
    "المدينة": "Medina",
    "المدينة المنورة": "Medina",
    "medina": "Medina",
    "al madinah": "Medina",
    "ينبع": "Yanbu",
    "الطائف": "Taif",
    "رابغ": "Rabigh",
    "الجموم": "Al Jumum",
    "الحناكية": "Al Hinakiyah",
    "العلا": "Al Ula",
    "خليص": "Khulays",
    "القنفذة": "Al Qunfidhah",
    "al-qunfudhah": "Al Qunfidhah",
    "الليث": "Al-Lith",
    "مدينة الملك عبدالله الاقتصادية": "King Abdullah Economic City",
    "الدمام": "Dammam",
    "al damam": "Dammam",
    "dammam": "Dammam",
    "الخبر": "Khobar",
    "al khobar": "Khobar",
    "الظهران": "Dhahran",
    "الجبيل": "Jubail",
    "jubail": "Jubail",
    "الأحساء": "Al Ahsa",
    "الاحساء": "Al Ahsa",
    "الهفوف": "Al Hofuf",
    "al-hafof": "Al Hofuf",
    "المبرز": "Al Mubarraz",
    "القطيف": "Qatif",
    "سيهات": "Sayhat",
    "بقيق": "Buqayq",
    "abqaiq": "Buqayq",
    "رأس تنورة": "Ras Tannurah",
    "الخفجي": "Al-Khafgy",
    "حفر الباطن": "Hafar Al-Batin",
    "النعيرية": "Nariyah",
    "عنك": "Inak",
    "قرية العليا": "Qaryat Al Ulya",
    "سلوى": "Salwa",
    "العيون": "Al Uyun",
    "الشرقية": "Eastern Province",
    "المنطقة الشرقية": "Eastern Province",
    "eastern": "Eastern Province",
    "القصيم": "Qassim",
    "qassim": "Qassim",
    "بريدة": "Buraydah",
    "عنيزة": "Unaizah",
    "البكيرية": "Al Bukayriyah",
    "المذنب": "Al Midhnab",
    "أوثال": "Awthal",
    "أبها": "Abha",
    "خميس مشيط": "Khamis Mushait",
    "عسير": "'Asir",
    "asir": "'Asir",
    "أحد رفيدة": "Ahad Rafidah",
    "النماص": "An Namas",
    "بيشة": "Bisha",
    "الحرجة": "Al Harajah",
    "المجاردة": "Al-Magerda",
    "جازان": "Jizan",
    "جيزان": "Jizan",
    "sabya": "Sabya",
    "أبو عريش": "Abu Arish",
    "أحد المسارحة": "Ahad Al Musarihah",
    "العارضة": "Al Aridah",
    "الدرب": "Al-Darb",
    "نجران": "Najran",
    "الباحة": "Al Bahah",
    "بلجرشي": "Biljurashi",
    "تبوك": "Tabuk",
    "حقل": "Haql",
    "ضباء": "Duba",
    "الوجه": "Al Wajh",
    "أملج": "Umluj",
    "أمالا": "Amaala",
    "حائل": "Hail",
    "الجوف": "Al Jawf",
    "سكاكا": "Sakaka",
    "دومة الجندل": "Dawmat Al Jandal",
    "القريات": "Al Qurayyat",
    "عرعر": "Arar",
    "رفحاء": "Rafha",
    "الحدود الشمالية": "Northern Borders",
}

# Where a result page of flat portal B keeps its links; the first selector that fits anything counts.
RESULT_LINKS = [
    "h2.search-job-title a.search-job-title-link",
    "h2 a[href*='/jobs/']",
    "h3 a[href*='/jobs/']",
    "a[href*='/jobs/']",
]
