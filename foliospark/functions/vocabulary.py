"""Word lists that the text operators take as parameters.

``DEFAULT`` holds what the operators' published results were made with; any
other corpus brings its own ``Vocabulary``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Vocabulary:
    numerals: str
    units: str
    sizes: str
    vague: tuple[str, ...]
    item_labels: tuple[str, ...]
    seasoning_labels: tuple[str, ...]
    section_words: tuple[str, ...]
    title_words: tuple[str, ...]
    headers: tuple[tuple[str, tuple[str, ...]], ...]
    contents: str
    category_suffix: str
    page_words: tuple[tuple[str, tuple[str, ...]], ...] = ()
    corpus_names: tuple[str, ...] = ()
    allowed_notes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    glue: str = ""
    number_names: tuple[str, ...] = ()
    bad_single: tuple[str, ...] = ()
    generic: tuple[str, ...] = ()
    prose_words: tuple[str, ...] = ()


# Published constants of the corpus the operators were made for.
DEFAULT = Vocabulary(
    numerals="〇零一二三四五六七八九十百半两几",
    units="钱两斤分个只片粒条张朵克根块付副枚棵把碗匙勺撮厘段头",
    sizes="大小",
    vague=("少许", "适量", "微量", "少量", "若干", "酌量"),
    item_labels=("主料", "配料", "原料", "用料"),
    seasoning_labels=("调料", "佐料", "辅料"),
    section_words=("用料", "原料", "材料", "配料", "主料", "调料", "作法", "制法", "做法", "方法", "制作", "特点", "说明", "附注", "注意", "备注"),
    title_words=("原料", "用料", "材料", "主料", "配料", "调料", "佐料", "辅料", "制法", "作法", "做法", "方法", "制作", "特点", "说明", "附注", "目录"),
    headers=(
        ("ingredients", ("原材料", "原料", "用料")),
        ("steps", ("制作方法", "制法", "作法", "方法", "制作")),
        ("tips", ("特点", "提示", "说明", "附注", "注")),
    ),
    contents="目录",
    category_suffix="类",
    page_words=(
        ("ingredients", ("原料", "用料", "配料", "主料")),
        ("seasonings", ("调料", "佐料", "辅料")),
        ("steps", ("制法", "作法", "制作", "方法")),
        ("tips", ("特点", "提示", "说明", "附注", "注")),
    ),
    corpus_names=("陕西菜谱",),
    allowed_notes=("清素",),
    prefixes=("水发", "净", "水", "熟", "生", "鲜", "干"),
    suffixes=("片", "丝", "米", "丁", "块", "条", "末"),
    glue="共各和与及或",
    number_names=("八角", "五花肉", "五花猪肉", "五花牛肉", "五花羊肉", "五香粉", "五香面", "三鲜", "千张", "百合", "十三香", "八宝", "四季豆", "一级羊肉"),
    bad_single=("角", "麻", "分", "子", "头", "皮", "水", "色"),
    generic=("主料", "配料", "调料", "原料", "用料", "适量", "少许", "各适量", "净", "各", "适当", "实耗", "实用", "约", "共", "料", "汁"),
    prose_words=("制法", "特点", "做法"),
)
