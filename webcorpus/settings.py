"""Fixed values and default limits."""

# Query parameters that only track where a click came from.
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"]

# Schemes a collected URL may have.
WEB_SCHEMES = ["http", "https"]

# Default host allowlist.
ALLOWED_HOSTS = ["www.weather.com.cn", "news.weather.com.cn", "p.weather.com.cn"]

# Shape of an article URL, /yyyy/mm/number.shtml at the very end.
ARTICLE_URL_PATTERN = r"/\p{Nd}{4}/\p{Nd}{2}/\p{Nd}+\.shtml?\n?\z"
ERROR_WORD = "error"

# Titles of galleries, videos and special pages.
TITLE_WORDS = ["图片频道", "视频", "直播", "专题"]
TITLE_SUFFIXES = ["-生活", "-图片频道"]

# Site menu words that show a body is navigation, not text.
NAV_MARKERS = ["热门城市", "热门景点", "选择省市", "选择洲际",
               "周边城市", "周边景点", "本地乡镇", "返回 全国"]

# Shown in place of an empty title or date, and cut from a comment's region.
NO_TITLE = "(无标题)"
NO_DATE = "-"
REGION_PREFIX = "来自"

# Header of the comment CSV.
COMMENT_CSV_FIELDS = ["评论id", "昵称", "地区", "评论"]

# Response codes worth another try.
RETRY_STATUSES = [429, 403, 500, 502, 503, 504]

MIN_ARTICLE_CHARS = 50
QUALITY_MIN_CHARS = 300
DEPTH_LIMIT = 2
PAGE_BUDGET = 200
ITEM_BUDGET = 30
RETRY_TIMES = 2
URLS_PER_HOST = 1
PAGES_PER_POST = 5000
TOP_DOMAINS = 10
RECENT_FINISHED = 5
PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
MESSAGE_TOPIC = "articles"
STATS_INTERVAL = "15 seconds"
