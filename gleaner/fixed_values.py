"""Fixed values.

Everything here must equal the values the curated results are defined by: enumerations, word lists,
patterns, limits and message texts. They are data, kept together so that a deployment for another domain
can pass its own.
"""

# --- enumerations -----------------------------------------------------------------------------------
SOURCE_TYPES = ["ai_media", "game_media", "ai_game_media", "official", "community"]
SOURCE_GROUPS = ["ai_native", "game_native", "ai_x_game", "official_community", "manual"]
PRIORITIES = ["high", "medium", "low"]
# collection strategy -> extractor that reads its payloads (None: nothing reads it)
STRATEGY_ROUTES = {
    "rss": "rss",
    "rsshub": "rss",
    "web_page": "web_page",
    "json_api": "json_api",
    "x_social": None,
    "manual_markdown": "manual_markdown",
    "official_site": "web_page",
    "community_submission": None,
}
SOURCE_NAME_CORRECTIONS = {
    "gcores": "机核",
    "chuapp": "触乐",
    "youxituoluo": "游戏陀螺",
    "youxichaguan": "游戏茶馆",
    "gamersky": "游民星空",
    "yystv": "游研社",
    "sjyx-luosiji": "罗斯基",
    "youxiputao": "游戏葡萄",
}

# --- defaults of the run parameters -------------------------------------------------------------------
COLLECTION_WINDOW_HOURS = 24
DEDUPE_WINDOW_HOURS = 72
MIN_AI_SCORE = 50
MIN_GAME_SCORE = 50
MIN_NEWS_VALUE = 55
MIN_CROSS_SCORE = 60
DAILY_ITEM_COUNT = 5
CATEGORY_QUOTAS = "AI x Game=5"
LOW_TRUST_WEIGHT = 40
LOW_TRUST_HIGH_SCORE = 85
FRESHNESS_HOURS = 72
MAX_ITEMS_PER_SOURCE = 50
MAX_ITEMS_TOTAL = 500
WEEKLY_LIMIT = 9
DEFAULT_SOURCE_WEIGHT = 50

# --- near-duplicate similarity -------------------------------------------------------------------------
NEAR_DUPLICATE_THRESHOLD = 0.66
TITLE_SHARE = 0.65
BODY_SHARE = 0.35
SAME_TITLE_SCORE = 0.78

# --- URL handling ----------------------------------------------------------------------------------------
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id",
    "fbclid", "gclid", "mc_cid", "mc_eid",
]
LINK_TRACKING_PARAMS = ["fbclid", "gclid", "mc_cid", "mc_eid"]

# --- text ---------------------------------------------------------------------------------------------------
TITLE_NOISE_WORDS = ["breaking", "exclusive", "update", "report"]
SELECTION_STOP_WORDS = [
    "about", "across", "after", "again", "announced", "around", "article", "because", "before", "being",
    "between", "daily", "deeper", "during", "entry", "general", "industry", "into", "latest", "moves",
    "official", "practical", "reported", "report", "reports", "source", "their", "there", "these", "this",
    "through", "today", "update", "using", "with", "without", "workflows",
]
ARTICLE_STOP_WORDS = [
    "about", "across", "after", "again", "announced", "around", "article", "because", "before", "being",
    "between", "daily", "during", "entry", "general", "industry", "into", "latest", "official", "reported",
    "report", "reports", "source", "their", "there", "these", "this", "through", "today", "update", "using",
    "with", "without", "workflows",
]
MOJIBAKE_CLASS = "[锛銆鈥涓鍚鐨鏈寮缁璇鏄鏉浣甯绗鍙]"
COMPARISON_PUNCTUATION_CLASS = r"""[“”"'‘’《》【】（）()：:，,。.!！？?、~\-—_\s]"""

# --- relevance signals: (label, pattern), matched on lower-cased title + newline + content ------------------
AI_SIGNALS = [
    ("AI", r"\bai\b"),
    ("AIGC", r"\baigc\b"),
    ("LLM", r"\bllm\b"),
    ("Agent", r"\bagents?\b"),
    ("人工智能", "人工智能"),
    ("生成式", "生成式"),
    ("大模型", "大模型"),
    ("智能体", "智能体"),
    ("机器学习", "机器学习"),
    ("文本生成", "文本生成"),
    ("图像生成", "图像生成"),
    ("语音生成", "语音生成"),
]
GAME_SIGNALS = [
    ("game", r"\bgames?\b"),
    ("gaming", r"\bgaming\b"),
    ("studio", r"\bstudio\b"),
    ("engine", r"\bengine\b"),
    ("NPC", r"\bnpc\b"),
    ("Roblox", r"\broblox\b"),
    ("Steam", r"\bsteam\b"),
    ("游戏", "游戏"),
    ("手游", "手游"),
    ("端游", "端游"),
    ("主机", "主机"),
    ("厂商", "厂商"),
    ("工作室", "工作室"),
    ("发行", "发行"),
    ("研发", "研发"),
    ("开发者", "开发者"),
    ("引擎", "引擎"),
    ("互动娱乐", "互动娱乐"),
]
CROSS_SIGNALS = [
    ("AI x 游戏", r"ai游戏|游戏ai|ai x game|游戏\s*\+\s*ai"),
    ("游戏开发", "游戏开发"),
    ("通用游戏AI", "通用游戏ai"),
    ("游戏画面", "游戏画面"),
    ("智能NPC", "智能npc"),
    ("AI生成", "ai生成"),
    ("游戏生产", "游戏生产"),
    ("游戏工业化", "游戏工业化"),
]
# the last alternation is bounded on its outer words only; that is part of the definition
VALUE_SIGNALS = [
    ("发布", "发布|上线|推出|接入"),
    ("融资", "融资|funding"),
    ("合作", "合作|partnership"),
    ("announce", r"\bannounce|release|launch\b"),
]
CROSS_LABEL = "AI x 游戏"

# ordered (reason, pattern) rules; the scorer takes the first, the screener all that hold
SCORER_TUTORIAL_PATTERN = r"\b(tutorial|how to|guide|tips)\b"
SCORER_GOSSIP_PATTERN = r"\b(celebrity|rumor|gossip|cosplay|meme)\b"
SCREEN_TUTORIAL_PATTERN = r"\b(tutorial|how to|guide|tips|prompt pack|course|learn)\b"
SCREEN_GOSSIP_PATTERN = r"\b(celebrity|rumor|gossip|cosplay|meme|trailer reaction|fan art)\b"
SCREEN_REPOST_PATTERN = r"\b(repost|roundup|icymi|in case you missed it)\b"

# --- rule prefilter, matched on lower-cased title + space + excerpt ------------------------------------------
PREFILTER_SOURCE_IDS = ["3dm", "gamersky"]
PREFILTER_MIN_SCORE = 8
# (label, points, patterns)
PREFILTER_RULES = [
    ("ai", 14, [
        r"(?:^|[^a-z])ai(?:[^a-z]|$)",
        r"aigc|llm|agent",
        r"人工智能|大模型|智能体|生成式|机器学习|神经网络|ai聊天|聊天ai",
    ]),
    ("game", 5, [
        r"游戏|手游|端游|主机|玩家|电竞|steam|xbox|playstation|ps5|switch|任天堂|索尼|微软|腾讯|网易|nvidia|r星|育碧|米哈游|工作室|开发商|发行商",
    ]),
    ("industry", 8, [
        r"引擎|开发者|研发|开发|发行|上线|融资|财报|营收|投资|收购|裁员|监管|审核|商业化|反作弊|工具|技术|测试|运营|合作|授权|并购",
        r"engine|developer|studio|publishing|funding|partnership|revenue|earnings|acquisition|layoff|regulation",
    ]),
    ("negative", -12, [
        r"美女|写真|主播|八卦|恋情|囧图|火辣|擦边|福利|小姐姐|颜值|cos|cosplay",
        r"史低|打折|促销|免费领|特惠|折扣|秒杀",
        r"手机|汽车|电动车|相机|耳机|显卡|主板|cpu|处理器|笔记本|内存|dram|硬盘|ssd",
        r"电影|电视剧|动画|漫画|票房|明星|演员",
    ]),
]
PREFILTER_OFF_TOPIC = ("off-topic-risk", -15)  # applied when the "game" rule does not hold

# --- reasons -----------------------------------------------------------------------------------------------------
REASON_LOW_INFORMATION = "low-information item"
LOW_INFORMATION_CHARS = 160
LOW_INFORMATION_SENTENCES = 3
REASON_TUTORIAL = "generic tutorial"
REASON_GOSSIP = "pure entertainment gossip"
REASON_REPOST = "low-information repost"
REASON_NON_AI = "non-ai game news"
REASON_LOW_CROSS = "low cross relevance"
REASON_LOW_VALUE = "low news value"
REASON_DUPLICATE = "duplicate"
REASON_NO_GAME = "ai news without game relevance"
REASON_UNRELATED = "unrelated to AI x game"
REASON_CROSS_BELOW = "cross relevance below threshold"
REASON_VALUE_BELOW = "news value below threshold"

VERIFY_BAD_URL = "source URL missing or was not collected successfully"
VERIFY_NO_TITLE = "article title is empty"
VERIFY_NO_BODY = "article body is empty"
VERIFY_BAD_DATE = "published date is not plausible for the daily window"
VERIFY_LOW_TRUST = "low-trust source requires a high score"
VERIFY_DUPLICATE = "duplicate_of is set"
VERIFY_NO_TRACE = "generated claims do not trace to raw content, summary, or source metadata"
AUDIT_SELECTED = "selected"
AUDIT_DUPLICATE = "duplicate_of respected"
AUDIT_NOT_CANDIDATE = "not a topic candidate"
AUDIT_OVER_COUNT = "eligible but outside configured daily count"

ARTICLE_NO_INTRO = "intro summary is empty"
ARTICLE_INTRO_SCRIPT = "intro summary must contain Chinese"
ARTICLE_NO_LINK = "source links are missing"
ARTICLE_LONG_PARAGRAPH = "article body contains an overlong paragraph"
ARTICLE_POINT_COUNT = "article body must contain exactly 3 numbered points"
ARTICLE_SHORT_POINTS = "article body numbered points are too short"
ARTICLE_INTRO_IS_TITLE = "intro summary is too similar to the title"
ARTICLE_MOJIBAKE = "generated text appears mojibake-corrupted"
ARTICLE_MISSING = "AI article generation failed"

# --- texts --------------------------------------------------------------------------------------------------------
FALLBACK_TITLE = "AI x 游戏候选新闻"
SELECTION_FALLBACK_NOTE = ("3. 来源：", "；这条候选已通过AI x 游戏相关性筛选，保守采用原始信息生成，避免发布未验证扩展判断。")
ARTICLE_FALLBACK_NOTE = ("3. 来源：", "；本条采用原始采集内容生成保守摘要，避免发布未通过验证的扩展判断。")
INTRO_CROSS = "聚焦 AI 与游戏结合的落地信号。"
INTRO_AI = "更偏 AI 方向，和游戏场景存在一定关联。"
INTRO_GAME = "目前更偏一般游戏资讯。"
INTRO_NO_SUBJECT = "该条动态"
BELOW_THRESHOLD_BODY = "This item stayed in the collection pool but did not clear the AI x game daily threshold. Original note: "
NO_SUMMARY = "No summary was generated."
NO_BODY = "_No article body was generated._"
EMPTY_DAY = "No AI x game topic candidates met the configured threshold."
EMPTY_WEEK = "No AI x game topic candidates were selected during this week."
EMPTY_DAY_PLAIN = "今天没有达到阈值的 AI x 游戏候选新闻。"
DAILY_TITLE = "Daily edition "
WEEKLY_TITLE = "Weekly edition "
WEEKLY_REBUILT_SUFFIX = " 入选当日日报。"
SCRIPT_EMPTY = "今天没有新闻达到 AI 游戏日报的筛选阈值。我们明天继续追踪。"
SCRIPT_INTRO = ("大家好，今天的 AI 游戏日报精选 ", " 条值得关注的消息。")
SCRIPT_TRANSITION = "接着看下一条。"
SCRIPT_OUTRO = "以上就是今天的重点。更多进展，我们下一期继续更新。"
SCRIPT_NO_DETAILS = "No details available"

# --- distribution --------------------------------------------------------------------------------------------------
# (platform, video, subtitles, markdown content, title limit, description limit)
PLATFORMS = [
    ("bilibili", True, True, False, None, 2000),
    ("youtube", True, True, False, 100, 5000),
    ("wechat", False, False, True, None, None),
    ("zhihu", False, False, True, None, None),
    ("xiaohongshu", True, False, True, None, None),
    ("douyin", True, False, False, None, None),
]
BASE_TAGS = ["AI", "Game", "News"]
MAX_TAGS = 20
PACKAGE_TITLE = " AI + Game News Daily"
PACKAGE_HEAD = "AI + Game News Daily packaged for manual publishing.\n\nTop stories:"
PACKAGE_TAIL = "Prepared locally without credentials or platform upload calls."

# --- listing-page templates: one row per site; every pattern yields its first group --------------------------------
LISTING_TEMPLATES = [
    {
        "source_id": "chuapp",
        "row": r'(?is)(<a class="fn-clear" href="[^"]+".*?<dl class="fn-left">.*?</dl>\s*</a>)',
        "url": r'(?i)<a class="fn-clear" href="([^"]+)"',
        "title": r"(?is)<dt>(.*?)</dt>",
        "time": r"(?i)</em>([^<]+)</span>",
        "excerpt": r"(?is)<dd>(.*?)</dd>\s*</dl>",
        "author": r"(?is)<em>(.*?)</em>",
    },
    {
        "source_id": "gcores",
        "row": r'(?is)(<a class="news" href="[^"]+".*?<h3>.*?</h3>.*?<div class="news_meta"><span class="me-3">.*?</span>)',
        "url": r'(?i)<a class="news" href="([^"]+)"',
        "title": r"(?is)<h3>(.*?)</h3>",
        "time": r'(?is)<span class="me-3">(.*?)</span>',
        "excerpt": None,
        "author": None,
    },
    {
        "source_id": "3dm",
        "row": r'(?is)(<li class="selectpost">.*?<a href="[^"]+" target="_blank" class="bt">.*?</a>.*?<span class="time">.*?</span>.*?<div class="miaoshu">.*?</div>.*?</li>)',
        "url": r'(?i)<a href="([^"]+)" target="_blank" class="bt">',
        "title": r'(?is)<a href="[^"]+" target="_blank" class="bt">(.*?)</a>',
        "time": r'(?is)<span class="time">(.*?)</span>',
        "excerpt": r'(?is)<div class="miaoshu">(.*?)</div>',
        "author": None,
    },
]
JSON_RECORD_PATH = "$.data.data"
JSON_RECORD_URL = ("https://www.youxituoluo.com/", ".html")

# --- list in a JSONP answer: element of a row, classes of its link, excerpt and time ---------------------------------
JSONP_LIST = {"block": "li", "link": "tt", "excerpt": "txt", "time": "time"}
