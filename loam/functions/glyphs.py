"""Text of legacy fonts as Unicode: native translations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loam.functions.text import body, chars_of, letters

#: The Symbol font's code points 20 to 7E and A0 to E5, in order.
SYMBOL_LOW = " !∀#∃%&∋()∗+,−./0123456789:;<=>?≅ΑΒΧΔΕΦΓΗΙϑΚΛΜΝΟΠΘΡΣΤΥςΩΞΨΖ[∴]⊥_‾αβχδεφγηιϕκλμνοπθρστυϖωξψζ{|}∼"
SYMBOL_HIGH = "€ϒ′≤⁄∞ƒ-♦♥♠↔←↑→↓°±″≥×∝∂•÷≠≡≈…|—↵ℵℑℜ℘⊗⊕∅∩∪⊃⊇⊄⊂⊆∈∉∠∇®©™∏√⋅-∧∨⇔⇐⇑⇒⇓◊〈®©™∑"
#: The characters that a layer of a TCVN3 font yields, with the letters meant in the same places, and those
#: that Vietnamese text in Unicode doesn't have.
TCVN3 = "¸µ¶·¹¨¾»¼½Æ©ÊÇÈÉËÐÌÎÏÑªÕÒÓÔÖÝ×ØÜÞãßáâä«èåæçé¬íêëìîóïñòô­øõö÷ùýúûüþ®¡¢£¤¥¦§−μ"
TCVN3_LETTERS = "áàảãạăắằẳẵặâấầẩẫậéèẻẽẹêếềểễệíìỉĩịóòỏõọôốồổỗộơớờởỡợúùủũụưứừửữựýỳỷỹỵđĂÂÊÔƠƯĐưà"
TCVN3_MARKERS = "¸µ¶·¹¨¾»¼½Æ©ÇÈÉËÐÎÏÑªÖ×ØÜÞßä«åæç¬ëîïñö÷øûüþ®§¡¢£¤¥¦"

_PUA = 0xF000
_SYMBOL = {chr(_PUA + 0x20 + i): c for i, c in enumerate(SYMBOL_LOW)} | {chr(_PUA + 0xA0 + i): c for i, c in enumerate(SYMBOL_HIGH)}
_SYMBOL |= {chr(_PUA + 0xF1): "〉", chr(_PUA + 0xF2): "∫", chr(_PUA + 0xFC): "-"}


def symbol_font(text: Column) -> Column:
    """Private-use characters of the Symbol font as what they show; those of the range that show nothing of their own go."""
    shown = F.translate(body(text), "".join(_SYMBOL), "".join(_SYMBOL.values()))
    return F.regexp_replace(shown, r"[\x{F020}-\x{F0FE}]", "")


def is_tcvn3(text: Column, share: float = 0.05) -> Column:
    """Whether markers of TCVN3 are at least a twentieth as many as the letters."""
    n = letters(text)
    return (n > 0) & (chars_of(text, TCVN3_MARKERS.replace("\\", "\\\\")) >= share * n)


def from_tcvn3(text: Column) -> Column:
    return F.translate(body(text), TCVN3, TCVN3_LETTERS)
