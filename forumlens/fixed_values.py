"""Settings, word lists and formats that results depend on.

All of them are defaults; every operator takes its own as a parameter.
"""

from __future__ import annotations

# ---- formats -------------------------------------------------------------------------------
PERMALINK_BASE = "https://reddit.com"
DELETED_AUTHOR = "[deleted]"
DELETED_BODY = "[deleted]"
REMOVED_BODY = "[removed]"
UNKNOWN_POST_TITLE = "[Unable to fetch post title]"
UNKNOWN_POST_ID = "unknown"
USER_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TRUNCATION_MARK = "... [truncated]"
COMMENT_SEPARATOR = " | "
UNCATEGORIZED = "uncategorized"
EVERYWHERE = "all Reddit"

# ---- collected files -----------------------------------------------------------------------
DAILY_FILES = ["daily", "activity_based"]
SEARCH_FILES = ["search", "data_tools"]

# ---- engagement and filters ----------------------------------------------------------------
DEFAULT_WEIGHTS = {"score": 0.3, "upvote_ratio": 0.2, "comments": 0.25, "comments_quality": 0.15, "recency": 0.1}
PRESET_WEIGHTS = {"score": 0.3, "upvote_ratio": 0.25, "comments": 0.25, "comments_quality": 0.15, "recency": 0.05}
PRESET_THRESHOLDS = {
    "min_engagement_score": 30,
    "min_score": 3,
    "min_comments": 1,
    "min_upvote_ratio": 0.6,
    "max_days_ago": 14,
}
STRICT_THRESHOLDS = {
    "min_engagement_score": 45,
    "min_score": 10,
    "min_comments": 5,
    "min_upvote_ratio": 0.7,
    "max_days_ago": 7,
}
RELEVANCE_CUT = 50
SEARCH_WINDOW_HOURS = 14 * 24
LISTING_WINDOW_HOURS = {"hour": 1, "day": 24, "week": 7 * 24, "month": 30 * 24, "year": 365 * 24, "all": None}

# ---- relevance -----------------------------------------------------------------------------
RELEVANT_TOPICS = [
    "etl", "bigquery", "tools", "automation", "databases",
    "api", "analytics", "performance", "snowflake", "databricks",
]
SOURCE_KEYWORDS = [
    "bing ads", "twitter ads", "tiktok ads", "snapchat ads", "facebook ads",
    "linkedin ads", "pinterest ads", "google ads", "campaign manager", "display video 360",
    "adroll", "taboola", "outbrain", "criteo", "apple search ads", "quora ads",
    "rakuten advertising", "spotify ads", "reddit ads", "youtube ads",
    "hubspot", "salesforce", "mailchimp", "activecampaign", "klaviyo",
    "brevo", "pipedrive", "zoho crm", "zendesk", "intercom", "freshdesk",
    "notion", "slack", "trello", "monday.com", "clickup", "jira",
    "google analytics", "adobe analytics", "amplitude", "mixpanel", "datadog",
    "google sheets", "airtable", "metabase", "surveymonkey", "typeform",
    "shopify", "bigcommerce", "woocommerce", "magento", "prestashop",
    "stripe", "braintree", "square", "quickbooks", "xero", "netsuite",
    "zuora", "chargebee", "maxio",
]
DESTINATION_KEYWORDS = [
    "bigquery", "snowflake", "redshift", "databricks", "looker studio",
    "power bi", "powerbi", "tableau", "google sheets", "excel",
    "amazon s3", "azure blob", "postgresql", "mysql", "sql server",
    "python", "r language", "jupyter", "notebooks",
]
IMPLEMENTATION_KEYWORDS = [
    "etl", "elt", "pipeline", "integration", "connector", "sync",
    "data warehouse", "data lake", "architecture", "optimization",
    "implementation", "migration", "setup", "configuration",
    "api integration", "data transformation", "data modeling",
    "performance tuning", "best practices", "troubleshooting",
    "data quality", "monitoring", "automation", "orchestration",
    "real-time", "batch processing", "incremental load",
]
BUSINESS_PATTERNS = [
    "connect.*to.*", "integrate.*with.*", "sync.*data",
    "etl.*pipeline", "data.*warehouse", "implementation.*challenge",
    "architecture.*question", "optimization.*problem", "migration.*",
    "best.*practice", "real.*time.*data", "batch.*processing",
]

# ---- topics --------------------------------------------------------------------------------
EXTRA_STOP_WORDS = [
    "data", "use", "using", "used", "like", "would", "could", "should",
    "getting", "need", "want", "trying", "looking", "help", "thanks",
    "anyone", "someone", "people", "way", "ways", "good", "best",
    "question", "questions", "know", "think", "time", "work", "working",
    "im", "ive", "dont", "didnt", "cant", "wont", "isnt", "arent",
]
TOPIC_CATEGORIES = {
    "etl": ["etl", "pipeline", "extract", "transform", "load", "data pipeline", "data integration"],
    "bigquery": ["bigquery", "gcp", "google cloud", "sql", "warehouse", "analytics"],
    "tools": ["tool", "tools", "airbyte", "fivetran", "dbt", "airflow", "dagster"],
    "automation": ["automation", "automated", "schedule", "workflow", "orchestration"],
    "databases": ["database", "postgres", "mysql", "snowflake", "redshift", "mongodb"],
    "api": ["api", "rest", "endpoint", "integration", "connector", "webhook"],
    "analytics": ["analytics", "analysis", "reporting", "dashboard", "visualization", "bi"],
    "performance": ["performance", "optimization", "slow", "speed", "latency", "scale"],
}

# ---- sentiment -----------------------------------------------------------------------------
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
NEVER_SO = 1.25
# idioms with their valence, as published with the method
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
CONTEXT_DAMPING = [1.0, 0.95, 0.9]
BUT_FACTORS = (0.5, 1.5)
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MAX = 0.18, 0.96
COMPOUND_ALPHA = 15.0
EDGE_PUNCTUATION = ".,!?_"

# ---- collection ----------------------------------------------------------------------------
TIERS = {
    "high_activity": {
        "subreddits": ["datascience", "marketing", "startups", "Entrepreneur"],
        "posts_per_sub": 150, "time_filter": "week", "description": "1M+ members",
    },
    "medium_activity": {
        "subreddits": [
            "shopify", "digital_marketing", "PPC", "analytics", "BusinessIntelligence", "PowerBI", "FacebookAds",
            "programacion", "dataanalysis", "AskMarketing", "ProductManagement", "SaaS", "ecommerce",
        ],
        "posts_per_sub": 100, "time_filter": "week", "description": "100K-1M members",
    },
    "low_activity": {
        "subreddits": [
            "tableau", "GoogleAds", "MarketingAutomation", "GoogleAnalytics", "bigquery", "snowflake",
            "GoogleDataStudio", "databricks", "nocode", "devsarg", "taquerosprogramadores", "dataanalyst",
            "chileIT", "automation", "datavisualization", "Dynamics365", "googlecloud", "shopifyDev",
            "roastmystartup", "agency",
        ],
        "posts_per_sub": 50, "time_filter": "week", "description": "10K-100K members",
    },
    "very_low_activity": {
        "subreddits": ["Looker", "LinkedInAds", "LookerStudio", "Fivetran", "datawarehouse", "ETL", "ColombiaDevs"],
        "posts_per_sub": 25, "time_filter": "week", "description": "<10K members",
    },
}
TARGET_KEYWORDS = ["data tools", "bigquery", "elt", "etl", "data pipeline", "data integration"]
BROAD_TERMS = [
    "data pipeline tools", "ETL solutions", "data integration platform", "business intelligence tools",
    "data warehouse tools", "analytics stack", "data connector", "data sync tools", "marketing data tools",
]
SEARCH_SUBREDDITS = [
    "analytics", "BusinessIntelligence", "bigquery", "snowflake", "datascience", "dataanalysis",
    "PowerBI", "tableau", "marketing", "digital_marketing", "MarketingAutomation",
]

# ---- model scoring -------------------------------------------------------------------------
TITLE_CHARS, CONTENT_CHARS, COMMENTS_CHARS = 400, 800, 2000
NO_CONTENT, NO_COMMENTS = "No content", "No comments available"
DEFAULT_MODEL_SCORE = 50.0
