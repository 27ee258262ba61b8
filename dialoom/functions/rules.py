"""Route, topic, behaviour, polarity and opening rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.text import NO, YES, nfkc, strip

# Domains and patterns of the dialogue rules.
ROUTES = ("无效模板", "ASR/噪声", "纯对话行为", "设备控制", "上下文不足", "有效内容")
TOPICS = ("影视动漫与角色", "电子游戏与互动玩法", "故事绘本与文学", "音乐儿歌与音频", "学习语言与数学", "科学自然与百科", "动物植物与宠物", "家庭校园与人际", "情绪陪伴与自我表达", "日常生活与饮食健康", "设备与产品使用", "其他明确内容")
BEHAVIORS = ("未识别行为", "提问求知", "请求内容", "游戏或角色扮演", "分享表达", "偏好表达", "反馈纠正", "上下文延续")
SIGNALS = ("无", "主动发起", "主动延续", "被动回应")
PURE_DIALOGUE = (
    r"^(?:嗯+|哦+|啊+|好(?:的|吧|呀|啊|啦)?|好呀好呀|行|对+|对呀对呀|是(?:的|的呀)?|不是(?:的|啊|呀)?|有|没有(?:没有|啊|呀|了)*|谢谢|再见|拜拜|hello|hi|"
    r"(?:我(?:也)?|他|她)?(?:不|没)知道(?:了|啦|啊|呀)?|我知道(?:了|啦|啊|呀)?|可以(?:的|了|啦|啊|呀|吧)?|不可以|会|不会(?:的)?|当然(?:了|啦)?|准备好(?:了|啦)?|"
    r"知道(?:了|啦|啊|呀)?|好(?:的|呀|啊|啦){2,}|你(?:好(?:呀|啊)?|是谁(?:呀|啊)?|叫什么名字(?:呀|啊)?|在干(?:嘛|什么)|(?:再|刚才)?说(?:一遍|什么|啥)?)|"
    r"我爱你|我不要|我没有|不告诉你|真的(?:吗|嘛)|(?:哈|呵|嘿|嘻){2,}|(?:喵|汪|喂){2,})$"
)
DEVICE_CONTROL = r"(?:调大|调小|音量|声音大|声音小|小声|大声|播放|暂停|停止|别说了|再说一遍|开灯|关灯|打电话|关机|充电|亮度)"
DEICTIC_ONLY = r"^(?:这个|那个|它|他|她|继续(?:讲|说|播放)?|然后呢|还有(?:呢|什么)?|再(?:说|讲|来|读|唱)(?:一遍|一个)?|换一个|等一下|妈妈|爸爸|爷爷|奶奶|外公|外婆|哥哥|姐姐|弟弟|妹妹)$"
CHINESE_NUMBER = r"^[零〇一二两三四五六七八九十百千万亿]+$"
QUESTION = r"(?:为什么|怎么|什么|谁|哪里|哪儿|几|吗|呢|能不能|可不可以|[?？])"
CONTENT_REQUEST = r"(?:讲|说|唱|播放|介绍|告诉我|读|画|编).*(?:故事|歌|一下|一个|给我)|^(?:讲|唱|读|画|介绍)"
PLAY = r"(?:玩|游戏|猜|扮演|对战|比赛|石头剪刀布|海龟汤)"
PREFERENCE = r"(?:我喜欢|最喜欢|我爱|不喜欢|讨厌|想看|想玩|想听|想聊)"
CORRECTION = r"(?:你(?:听|说|答|理解|搞)错|我(?:刚才)?说的是|回答错|答错|^不对(?:$|你|我|应该|是))"
SHARE = r"(?:我今天|我昨天|我有|我去|我看过|我玩过|我觉得|我在)"
SUBSTANTIVE = r"(?:为什么|怎么|什么|谁|哪里|想|喜欢|不喜欢|讲|说|玩|看|听|觉得|因为|会不会|厉害|故事|角色|名字)"
CONTENT_HINT = r"(?:天气|时间|故事|音乐|儿歌|数学|英语|学校|妈妈|爸爸|朋友|开心|难过|动物|植物|吃|睡|机器人|百科)"
TOPIC_RULES = (
    r"动画|动漫|电影|电视|角色|奥特曼|公主|汪汪队", r"游戏|对战|闯关|我的世界|植物大战僵尸|王者荣耀|海龟汤", r"故事|绘本|童话|小说|诗|成语", r"音乐|歌曲|唱歌|儿歌|歌词|播放",
    r"学习|作业|考试|数学|加法|减法|英语|拼音|汉字", r"科学|为什么|百科|历史|宇宙|地球|恐龙|天气", r"动物|植物|宠物|猫|狗|兔|熊猫|花|树", r"妈妈|爸爸|家人|老师|同学|朋友|学校|幼儿园",
    r"开心|难过|害怕|生气|孤独|想念|喜欢|讨厌", r"吃饭|食物|水果|睡觉|洗澡|生病|身体|运动|出去|回家", r"设备|机器人|电量|充电|屏幕|音量|电话",
)
CONTINUE_REQUEST = r"^(?:继续(?:讲|说)?|然后呢|还有呢|再讲一个)$"
NEGATIVE = r"(?:不喜欢|讨厌|不想(?:看|玩|听|聊)|别(?:讲|说)|不要(?:讲|说))"
POSITIVE = r"(?:喜欢|最爱|我爱|想(?:看|玩|听|聊))"
CLAUSE_BREAK = r"[，。！？,!?;；]|但是|不过|而且|然后"
NEXT_PREDICATE = r"(?:但|而|也)?(?:不喜欢|讨厌|喜欢|想看|想玩|想听|想聊|讲讲)"
NOISE = r"^(?:(.)\1{3,}|\d+)$"
# Openings.
PLACEHOLDER = "##{startPrompt}##"
LEGACY_EXACT = ("围绕这个内容你可以问我一个相关的问题吗直接展示一句话简洁问题内容", "围绕这个内容你可以和我讨论下里面的知识吗直接展示一句话简洁问题内容", "围绕这个内容你可以和我讨论有趣的观点吗直接展示一句话简洁问题内容")
LEGACY_PREFIX = "和我打招呼并称呼我的名字"
SYSTEM_HINTS = ("小朋友请靠近我按住按键对话哦", "请靠近我不要堵住麦克风再说一遍哦")
DIRECTIONS = {
    "knowledge": ("知识计划",), "operation": ("运营计划", "运营任务+任务标题", "运营计划/运营任务+任务标题"), "preference": ("高频兴趣",), "unfinished_topic": ("未完成任务", "未完话题", "未完成任务/未完话题"),
    "birthday": ("生日",), "anniversary": ("纪念日",), "holiday": ("节日",), "night": ("夜间陪伴",), "fallback": ("默认日常开场",), "general_interest": ("通用兴趣",),
}
OPERATION_PREFIXES = ("运营计划/运营任务+", "运营任务+")


def first_of(*cases: tuple[Column, object], otherwise: object) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(otherwise)


def route(norm: Column, is_invalid: Column, is_template: Column, has_entity: Column) -> Column:
    """E6."""
    size = F.char_length(norm)
    return first_of(
        ((is_invalid != NO) | (is_template == YES), ROUTES[0]), (has_entity, ROUTES[5]), ((norm == "") | norm.rlike(NOISE), ROUTES[1]), (norm.rlike(DEVICE_CONTROL), ROUTES[3]),
        (norm.rlike(PURE_DIALOGUE), ROUTES[2]), (norm.rlike(DEICTIC_ONLY) | norm.rlike(CHINESE_NUMBER), ROUTES[4]),
        ((size <= 1) | ((size <= 2) & ~norm.rlike(CONTENT_HINT)), ROUTES[1]), otherwise=ROUTES[5],
    )


def topic(norm: Column, entity_topic: Column | None = None) -> Column:
    """The first entity's topic, else the first keyword rule."""
    found = first_of(*[(norm.rlike(rule), name) for rule, name in zip(TOPIC_RULES, TOPICS, strict=False)], otherwise=TOPICS[-1])
    return found if entity_topic is None else F.coalesce(entity_topic, found)


def behavior(norm: Column) -> Column:
    """E8."""
    return first_of((norm.rlike(CORRECTION), BEHAVIORS[6]), (norm.rlike(PREFERENCE), BEHAVIORS[5]), (norm.rlike(CONTENT_REQUEST), BEHAVIORS[2]), (norm.rlike(PLAY), BEHAVIORS[3]),
                    (norm.rlike(QUESTION), BEHAVIORS[1]), (norm.rlike(DEICTIC_ONLY), BEHAVIORS[7]), (norm.rlike(SHARE), BEHAVIORS[4]), otherwise=BEHAVIORS[0])


def polarity(text: Column) -> Column:
    """Negatives are taken out before positives are looked for."""
    negative, positive = text.rlike(NEGATIVE), F.regexp_replace(text, NEGATIVE, "").rlike(POSITIVE)
    return first_of((negative & positive, "mixed"), (negative, "negative"), (positive, "positive"), otherwise="neutral")


def opening_category(text: Column, norm: Column) -> Column:
    """X9."""
    raw = strip(text)
    return first_of((raw == PLACEHOLDER, "startPrompt"), (norm.isin(*LEGACY_EXACT) | raw.startswith(LEGACY_PREFIX), "legacyDefault"), otherwise="other")


def is_reply(text: Column, norm: Column) -> Column:
    """X10."""
    return (strip(text) != "") & (opening_category(text, norm) == "other") & ~norm.isin(*SYSTEM_HINTS)


def direction_of(prompt: Column) -> Column:
    """What stands before the first '==' (1 to 120 characters of one line), by alias or operation prefix; null if there is none, 'unsupported' if unknown."""
    prefix = F.regexp_replace(strip(F.regexp_extract(strip(nfkc(prompt, "lower")), r"^([^\r\n=]{1,120})==", 1)), " ", "")
    cases = [(prefix.startswith(p) & (F.char_length(prefix) > len(p)), "operation") for p in OPERATION_PREFIXES]
    cases += [(prefix.isin(*[a.lower() for a in aliases]), key) for key, aliases in DIRECTIONS.items()]
    return F.when(F.coalesce(prefix, F.lit("")) == "", F.lit(None)).otherwise(first_of(*cases, otherwise="unsupported"))


def row_order(timestamp: Column, created_at: Column, source_row: Column) -> Column:
    """The ordering key of rows in a session; invalid timestamps count 0, and so do those that ``is_orderable`` rejects."""
    stamp = strip(timestamp.cast("string")).try_cast("double")
    return F.struct(F.coalesce(F.when(_finite(stamp), stamp), F.lit(0.0)).alias("ts"), strip(created_at).alias("at"), source_row.cast("long").alias("row"))


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def is_orderable(timestamp: Column) -> Column:
    """False for NaN and infinity, by which no first row can be told."""
    return F.coalesce(_finite(strip(timestamp.cast("string")).try_cast("double")), F.lit(True))


def opening_prompt(response: Column) -> tuple[Column, Column]:
    """X11: whether a response is a JSON object (empty counts as one), and its ``extra.opening_prompt`` if that is a string."""
    value = F.try_parse_json(F.coalesce(F.nullif(response, F.lit("")), F.lit("{}")))
    found = F.try_variant_get(value, "$.extra.opening_prompt", "variant")
    is_text = F.schema_of_variant(found) == "STRING"
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), F.when(is_text, F.try_variant_get(value, "$.extra.opening_prompt", "string"))
