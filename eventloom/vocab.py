"""Fixed values of the analysed export: event names, parameter keys and lookup tables.

They are data, not logic: results only agree with existing reports when these match.
Operators take all of them as arguments, so another vocabulary can be passed instead.
"""

from eventloom.context import Roles

# ---- fixed values: event roles ----
GA4_ROLES = Roles(
    exposure="page_voice_design_exposure",
    entries=("creation_voice_design_click", "voice_library_voice_design_click"),
    generate="voice_design_generate_click",
    select="voice_design_select_click",
    save="voice_design_save_success",
    save_use="voice_design_save_voice_use",
    complete_back="voice_design_complete_back",
    prompt="voice_design_prompt_click",
    label_adjust="voice_design_label_adjust",
    description_adjust="voice_design_description_adjust",
    rate="voice_design_listen_grade",
    upgrade_popup="voice_design_upgrade_popup",
    upgrade_confirm="voice_design_upgrade_confirm_click",
    upgrade_cancel="voice_design_upgrade_cancel_click",
    payment_like="%payment_success%",
    credit="credit_reduce",
    credit_feature="voice_design",
    tts="tts_generate_click",
    tts_feature_path="/voice/design",
    template_click="voice_design_template_click",
    generate_success="voice_design_generate_success",
    path_excluded=(
        "page_voice_design_exposure",
        "session_start", "first_visit", "first_open",
        "user_engagement", "scroll", "page_view",
        "click", "file_download", "view_search_results",
    ),
    path_excluded_suffix="_bounce",
    path_kept="page_voice_design_bounce",
)

# ---- fixed values: parameter keys ----
ACTION = "action"
CREDIT_TYPE = "type"
CREDITS = "credits"
VOICE_ID = "voice_id"
FROM_PATH = "from"
SESSION_ID = "ga_session_id"
TEMPLATE_ID = "templateId"
FROM_CACHE = "from_cache"

LIKE = 1
DISLIKE = 2
VOICES_PER_GENERATE = 3

# ---- fixed values: event labels shown in path trees ----
EVENT_LABELS = {
    "page_voice_design_bounce": "离开Design页",
    "voice_design_prompt_click": "点击Prompt",
    "voice_design_upgrade_confirm_click": "点击Upgrade",
    "signup_success": "注册成功",
    "signup_click": "点击注册",
    "google_login_click": "谷歌登录",
    "login_success": "登录成功",
    "page_tts_creation_exposure": "进入TTS创作页",
    "page_tts_creation_bounce": "离开TTS创作页",
    "page_voice_clone_exposure": "进入Voice Clone页",
    "page_voice_clone_bounce": "离开Voice Clone页",
    "page_voice_lib_exposure": "进入音色库",
    "page_voice_lib_bounce": "离开音色库",
    "page_voice_sound_exposure": "进入Sound Design页",
    "page_voice_sound_bounce": "离开Sound Design页",
    "page_landing_exposure": "进入Landing页",
    "page_landing_bounce": "离开Landing页",
    "page_explore_exposure": "进入探索页",
    "guide_exposure": "引导曝光",
    "guide_click": "点击引导",
    "guide_dismiss": "关闭引导",
    "voice_search_result_exposure": "搜索结果曝光",
    "voice_clone_add_voice_click": "添加克隆音色",
    "voice_play_click": "播放音色",
    "tts_generate_click": "TTS生成",
    "tts_inputdetail": "TTS输入内容",
    "tts_playback_click": "TTS播放",
    "creation_voice_card_click": "点击音色卡片",
    "creation_voice_clone_click": "点击Voice Clone",
    "creation_voice_design_click": "点击Voice Design",
    "voice_library_voice_design_click": "从音色库进Design",
    "credit_reduce": "Credits消耗",
    "page_video_videoList_exposure": "进入视频列表",
    "NEX-page_voice_design_bounce": "离开Design页(NEX)",
    "NEX-page_tts_creation_exposure": "进入TTS创作页(NEX)",
    "voice_clone_preview_listen_play_click": "试听克隆音色",
}

# ---- fixed values: templates by language ----
TEMPLATE_PREFIX = "voice_design_templates_"
TEMPLATES = {
    "zh": (
        "午夜电台", "创世女神", "外星来客", "财经博主", "营销号解说", "人工智能",
        "鸡血带货", "悲伤诉说", "胡同老大爷", "激动的包子", "数学老师", "猫猫网红",
    ),
    "en": (
        "Sorrow American Narrator", "Cat Influencer", "Elegant British Narrator", "Goddess of Creation",
        "Soft ASMR Mindfulness", "The Dark Commander", "Youtube Indian Teacher", "Alien",
        "Silicon Valley Prodigy", "Energy Comms", "AI Robotic Engine", "Speaking Hamburger",
    ),
    "ja": ("長官", "創世の女神", "宇宙人", "激烈な論争", "華麗なる悪役", "人工知能", "優雅なお嬢様", "内なる独白"),
}
TEMPLATE_LANG = {TEMPLATE_PREFIX + name: lang for lang, names in TEMPLATES.items() for name in names}
LANGUAGES = tuple(TEMPLATES)

# ---- fixed values: tags ----
TAG_PATTERN = r"\[([^\[\]#]*)#([^\[\]]*)\]:"
BASE_EMOTIONS = ("Happy", "Anger", "Sadness", "Fear")
PRESET_TAGS = ("surprise", "excited", "dramatic", "proud", "empathetic", "curious", "frustrated", "envious")
RATE_BANDS = ((20.0, "high"), (15.0, "mid"))
