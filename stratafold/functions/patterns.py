"""The expressions, word lists, limits and tables that decide what the engine recognises. They are data, kept as they must be."""

from __future__ import annotations

from typing import NamedTuple


class Rx(NamedTuple):
    pattern: str
    ignore_case: bool = False


class Parser:
    """Fixed values of the line and value detectors."""

    FRONT_MATTER_CUE_RE = Rx('(?:备案号|邮政编码|邮编|电话|传真|网址|网站|印数|定价|出版|发行|版权|ISBN|地址|前言|免费标准下载|标准分享网)', True)
    FRONT_MATTER_SECTION_RE = Rx('(?:前言|文件基础信息|版权|出版|发行)', True)
    NUMBERED_HEADING_RE = Rx('^(\\d+(?:\\.\\d+)*)(?:[.)])?\\s+(.+)$')
    PART_HEADING_RE = Rx('^(第\\s*\\d+\\s*部分|Part\\s+\\d+|Teil\\s+\\d+)(?:\\s*[:\\-]\\s*(.+))?$', True)
    STANDARD_RE = Rx('\\b((?:DIN|EN|ISO|IEC|JIS|ASTM|SN|SEW|DVS|AD|TRbF|GB|CB|CH|JB|YB|HG|QC|LY|BB|MT|SH|SY|DL|JJG|JJF)(?:/[TZ])?(?:\\s+[A-Z]+)?\\s*[0-9][0-9A-Za-z./\\-—–─_]*)\\b')
    TABLE_CAPTION_RE = Rx('^(?:表|Table|Tabelle)\\s*\\d+[:\\s\\-]?(.*)$', True)
    FIGURE_CAPTION_RE = Rx('^(?:图|Figure|Fig\\.?)\\s*\\d+[:\\s\\-]?(.*)$', True)
    GENERIC_SHORT_HEADING_RE = Rx('(application|scope|dimensions|requirements|inspection|material|packaging|marking|summary|anwendungsbereich|maße|werkstoff|zitierte normen|prüfung|dichtung|standard lengths|admissible length deviation|specification in the bill of materials|weitere maße|bezeichnungsbeispiel)', True)
    LEGAL_NOTICE_RE = Rx('(all rights reserved|copyright|patent|utility model|未经书面许可不得复制)', True)
    BOILERPLATE_FRAGMENT_RE = Rx('(?:express authorization is prohibited|offenders will be held liable|this copy will not be updated|latest german-language version|of this standard shall be taken as authoritative)', True)
    ADVERTISEMENT_NOISE_RE = Rx('(?:https?://|www\\.|17jzw|bzfxw|分享网|免费下载|标准下载|道客巴巴|文库|淘宝)', True)
    REVISION_RE = Rx('(修订|修订记录|变更|revision|change log|änderung)', True)
    MODEL_RE = Rx('\\b[A-Z]{1,5}(?:[-/][A-Z0-9]{2,}|\\d{2,}[A-Z0-9/-]*)\\b')
    PRODUCT_HINT_RE = Rx('(型号|系列|规格|参数|订货|选型|model|series|specification|ordering|type)', True)
    APPLICATION_HINT_RE = Rx('(应用|适用|用途|application|scope|anwendungsbereich)', True)
    INSPECTION_HINT_RE = Rx('(检验|检测|试验|inspection|test|prüfung|pruefung)', True)
    RULE_PATTERNS = [
        (Rx('(不得|禁止|不允许|must not|shall not|darf nicht|dürfen nicht)', True), '禁止'),
        (Rx('(必须|应当|应|shall|must|muss|müssen|ist zu)', True), '必须'),
        (Rx('(建议|宜|should|recommended|sollte|sollen)', True), '建议'),
    ]
    UNIT_TOKEN_RE = Rx('(mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°)')
    RANGE_RE = Rx('(\\d+(?:[.,]\\d+)?)\\s*(?:to|bis|至|~|～|—|-+)\\s*(\\d+(?:[.,]\\d+)?)(?:\\s*(mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°))?', True)
    COMPARE_RE = Rx('(≤|≥|<|>|=|\\+/-|±)\\s*(\\d+(?:[.,]\\d+)?)(?:\\s*(mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°))?', True)
    HEADER_VALUE_RE = Rx('^(?:DN|d\\d+|l\\d+|s|t|h|w|weight|gewicht|mass|length|angle)$', True)
    GENERIC_NOISE_HEADING_RE = Rx('^(?:sn\\s*\\d+|din\\s*\\d+|en\\s*\\d+|iso\\s*\\d+|page\\s+\\d+|seite\\s+\\d+)$', True)
    NOISE_MARKER_RE = Rx('^(?:bearbeitet:?|edited:?|draft|status)$', True)
    SECTION_NUMBER_ONLY_RE = Rx('^\\d+[.)]?$')
    SPLIT_HEADING_NUMBER_RE = Rx('^\\d+(?:\\.\\d+)*[.)]?$')
    SHORT_TOKEN_RE = Rx('^[A-Z]{1,3}$')
    LETTER_RANGE_RE = Rx('^[A-Z](?:\\s*-\\s*[A-Z])+$')
    VALUE_FRAGMENT_RE = Rx('^(?:[+\\-]|≤|≥|<|>)?\\s*(?:DN\\s*)?\\d+(?:[.,]\\d+)?\\s*%?$', True)
    LOWERCASE_FRAGMENT_RE = Rx('^[a-zäöü]')
    LEADING_CONJUNCTION_RE = Rx('^(?:and|und|or|oder)\\b', True)
    ICS_RE = Rx('^ICS\\s+\\d+(?:\\.\\d+)*$', True)
    SENTENCE_VERB_RE = Rx('\\b(?:beträgt|ist|sind|muss|müssen|werden|wird|can|shall|must|used|pointing|given)\\b', True)
    LOW_SIGNAL_TABLE_TITLE_RE = Rx('^(?:zitierte normen|引用标准|reference(?:s)?|references|weitere normen|further standards|additional standards|frühere ausgaben|fruhere ausgaben|earlier editions)$', True)
    REFERENCE_SECTION_TITLE_RE = Rx('^(?:zitierte normen|引用标准|references|reference standards|referenced standards|weitere normen|further standards|additional standards)$', True)
    REVISION_SECTION_TITLE_RE = Rx('^(?:frühere ausgaben|fruhere ausgaben|earlier editions)$', True)
    TOC_LINE_RE = Rx('(?:\\.|…){5,}\\s*\\d+(?:\\+\\d+)?\\s*$')
    TOC_HEADER_RE = Rx('\\b(?:contents|inhalt|目录)\\b', True)
    METADATA_LABEL_RE = Rx('^(?:normenstelle|normungsstelle)$', True)
    TOTAL_PAGES_RE = Rx('^(?:total number of pages|gesamtseitenzahl)\\s+\\d+\\b', True)
    EDITION_HEADER_RE = Rx('^(?:[A-Z]{1,4}\\s*\\d+(?:[-/]\\d+)?\\s*:\\s*)?\\d{4}(?:-\\d{2})?\\s+edition\\b', True)
    PAGE_HEADER_NOISE_RE = Rx('^(?:page|supersedes|contents|index)$', True)
    DOC_VERSION_RE = Rx('^(?:DIN|EN|ISO|SN|SEW|DVS|AD|TRbF)\\s+\\d[\\dA-Za-z./\\-]*(?:\\s*:\\s*\\d{4}(?:-\\d{2})?)?$', True)
    CORPORATE_NOTICE_RE = Rx('(?:SMS\\s+Demag\\s+AG|all rights reserved|no guarantee can be given)', True)
    FOOTNOTE_CONTINUE_RE = Rx('^(?:footnotes?\\s+see\\s+page\\s+\\d+|continued\\s+on\\s+page\\s+\\d+)$', True)
    METADATA_PREFIX_RE = Rx('^(?:bearbeitet|edited)\\s*:', True)
    FOOTNOTE_MARKER_RE = Rx('^\\d+\\)$')
    TABLE_HEADER_FRAGMENT_RE = Rx('^(?:operat(?:ing)?\\.?\\s*pressure|pressure|bending|radius|rmin|dynamic|static|weight|kg\\s*/\\s*m|bar|dn|min\\.?|max\\.?)$', True)
    HEADER_TOKEN_FRAGMENT_RE = Rx('^(?:[dls]\\s*\\d(?:\\)\\s*\\d+)?|r\\s*min)$', True)
    DATE_PREFIX_HEADING_RE = Rx('^\\d{2}\\.\\d{2}\\.\\d{2}\\s+(Shape\\s+[A-Z])$', True)
    NUMERIC_PREFIX_HEADING_RE = Rx('^\\d{3,4}\\s+(Admissible length deviation)$', True)
    SCAN_TEXT_RE = Rx('[A-Za-z一-鿿]')
    DATE_LIKE_RE = Rx('\\b\\d{4}(?:[-—–/.]{1,2}\\d{1,2}){1,2}\\b')
    METADATA_PARAM_RE = Rx('(?:分类号|发布|实施|代替|计划项目代号|标准编号|版本日期|ICS)', True)
    SPEC_TOKEN_RE = Rx('(?:PN\\s*\\d+(?:[.,]\\d+)?|M\\d+(?:X\\d+(?:[.,]\\d+)?)?|DN\\s*\\d+|\\d+(?:[.,]\\d+)?\\s*(?:MPa|bar|mm|cm|m|kg|g|℃|°C|%))', True)
    SENTENCE_DATA_CUE_RE = Rx('[，、；。]|(?:为|按|采用|公称|通径|规格|尺寸|材料)')
    LEADING_NUMERIC_CJK_GLUE_RE = Rx('^(?:[+\\-]|≤|≥|<|>|=|±)?\\s*\\d+(?:[.,]\\d+)?(?=[一-鿿])')
    SENTENCE_HEADING_CUE_RE = Rx('(?:应|必须|不得|不允许|注明|持续时间|内容|说明|采用|关闭|打开|提交|进行)')
    PURE_NUMERIC_VALUE_RE = Rx('^(?:[+\\-]|≤|≥|<|>|=|±)?\\s*\\d+(?:[.,]\\d+)?(?:\\s*(?:MPa|kPa|Pa|mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°))?$', True)
    DIMENSION_VALUE_RE = Rx('^\\d+(?:[.,]\\d+)?(?:\\s*[x×]\\s*\\d+(?:[.,]\\d+)?){1,3}(?:\\s*(?:MPa|kPa|Pa|mm|cm|m|μm|µm|um|bar|psi|°C|℃|K|%|A/m|N/mm2|N/mm²|kN/m2|kg|g|°))?$', True)
    CODE_LIKE_VALUE_RE = Rx('^[A-Za-z]{1,8}\\d+(?:[-—–/][A-Za-z0-9.]+)+$', True)
    UNIT_ONLY_FRAGMENT_RE = Rx('^[()（）\\[\\]]*(?:mm|cm|m|kg|g|℃|°C|bar|MPa|kPa|Pa|DN|PN|个)[()（）\\[\\]]*[；;。.]?$', True)
    LETTER_MARKER_RE = Rx('^[A-Za-z][.)]?$')
    COMMON_SHORT_CJK_HEADING_RE = Rx('^(?:范围|前言|术语|定义|要求|代号|分类|标记|包装|运输|贮存|材料|尺寸|结构|检验|试验|说明|附录|引用文件|规范性引用文件)$')
    INSPECTION_METHODS = [('超声', '超声波检测'), ('磁粉', '磁粉检测'), ('渗透', '渗透检测'), ('硬度', '硬度检验'), ('pressure test', '压力检验'), ('prüfung', '检验'), ('inspection', '检验'), ('test', '试验')]


class Profile:
    """Fixed values of the text layer and document type."""

    NUMBERED_HEADING_RE = Rx('^\\d+(?:\\.\\d+){0,4}\\s+\\S+')
    PART_RE = Rx('^(?:第\\s*\\d+\\s*部分|Part\\s+\\d+|Teil\\s+\\d+)', True)
    STANDARD_RE = Rx('\\b(?:DIN|EN|ISO|SN|SEW|DVS|AD|TRbF|GB|CB)(?:\\s+[A-Z]+)?\\s*[0-9][0-9A-Za-z./\\-—–]*\\b')
    MODEL_RE = Rx('\\b[A-Z]{1,5}(?:[-/][A-Z0-9]{2,}|\\d{2,}[A-Z0-9/-]*)\\b')
    PRODUCT_HINT_RE = Rx('(型号|系列|规格|参数|订货|选型|model|series|specification|ordering|type)', True)
    MANUAL_HINT_RE = Rx('(安装|操作|维护|步骤|警告|注意|installation|operation|maintenance|warning|caution)', True)
    REPORT_HINT_RE = Rx('(报告|证书|检验记录|测试结果|certificate|report|inspection|test report)', True)
    ENGLISH_HINT_RE = Rx('\\b(the|and|for|with|application|dimensions|standard|requirements|inspection)\\b', True)
    GERMAN_HINT_RE = Rx('\\b(und|für|mit|maße|teil|anwendungsbereich|werkstoff|zitierte|prüfung)\\b', True)
    VALID_CHAR_RE = Rx('[一-鿿A-Za-z0-9，。、；：！？“”‘’（）【】《》,.;:!?\\(\\)\\[\\]\\s]')
    WATERMARK_URL_RE = Rx('(?:https?://|www\\.)[\\w\\-.]+\\.(?:com|cn|net|org|html?|asp|php)', True)
    WATERMARK_KEYWORDS_RE = Rx('免费下载|建站|分享网|标准分享|bzfxw|17jzw|淘宝|文库|道客巴巴')
    ADVERTISEMENT_LINE_RE = Rx('(?:17jzw|bzfxw|分享网|免费下载|建站平台|商业网站|标准下载|文库|道客巴巴|淘宝|www\\.)', True)
    FRONT_MATTER_LINE_RE = Rx('(?:备案号|邮政编码|邮编|电话|传真|网址|网站|印数|定价|出版|发行|版权|ISBN|地址|前言|发布|实施)', True)
    STANDARD_ENTITY_RE = Rx('(?:GB|CB|ISO|GB/T|CB/T)\\s*\\d+-\\d+')
    NUMERIC_PARAM_RE = Rx('\\d+\\s*(?:mm|kg|MPa|℃)')
    SECTION_NUM_RE = Rx('(?m)^\\s*\\d+\\.\\d+')
    SECTION_SIGNAL_LINE_RE = Rx('^(?:\\d+(?:\\.\\d+){0,4}\\s+\\S+|第\\s*\\d+\\s*(?:章|节|部分)?|范围\\b|要求\\b|代号\\b|术语\\b|定义\\b|标记\\b|包装\\b|运输\\b|贮存\\b|试验\\b|检验\\b)', True)
    TABLE_SIGNAL_RE = Rx('(?:^|[\\s(（])(?:表|图|Table|Figure|Fig\\.?|Tabelle)\\s*\\d+', True)
    CONTENT_LINE_RE = Rx('[一-鿿A-Za-z0-9]')


class Review:
    """Fixed values of the review rules."""

    FRONT_MATTER_PARAM_RE = Rx('(?:备案号|邮政编码|邮编|电话|传真|网址|网站|印数|定价|出版|发行|版权|ISBN|地址|前言|free download)', True)
    FRONT_MATTER_VALUE_RE = Rx('(?:\\b\\d{6}\\b|(?:\\(?0\\d{2,4}\\)?[-\\s]?)?\\d{5,8}(?:[-\\s]\\d{1,4})?|定价\\s*\\d+(?:\\.\\d+)?\\s*元|印数\\s*\\d+\\s*[-~]\\s*\\d+|ISBN\\s*[:：]?\\s*[\\d-]+)', True)
    TABLE_DRIVEN_TITLE_RE = Rx('(?:连接尺寸|密封面|垫片|填料|选用)', True)
    TABLE_DRIVEN_BODY_RE = Rx('(?:表\\s*\\d+|对照表|\\bPN\\s*\\d+|\\bDN\\s*\\d+|公称压力|温度|介质|连接尺寸|密封面)', True)
    OCR_TABLE_CAPTION_RE = Rx('(?:^|\\b)(?:table|tabelle)\\s*\\d+\\b|表\\s*\\d+', True)
    OCR_TABLE_SIGNAL_RE = Rx('(?:\\bPN\\s*\\d+|\\bDN\\s*\\d+|公称压力|温度|介质|连接尺寸|密封面|operating pressure|bending radius|dimensions?|maße|gewicht|weight)', True)
    STANDARD_CODE_RE = Rx('\\b(?:DIN|EN|ISO|SN|SEW|DVS|AD|TRbF|GB|CB)(?:\\s+[A-Z]+)?\\s*[0-9][0-9A-Za-z./\\-—–]*\\b')
    SYNTHETIC_TABLE_TITLE_RE = Rx('^#+\\s+第\\d+页表\\d+$')
    SHORT_HEADING_RE = Rx('^#+\\s+[A-Z]{1,3}$')
    SENTENCE_HEADING_RE = Rx('^#+\\s+.*[.;]$')
    SUSPICIOUS_PARAM_TAG_RE = Rx('(?:\\d+[.)/]?\\s*){2,}|(?:\\b[a-z]{1,3}\\b\\s*){2,}', True)
    SUSPICIOUS_OCR_HEADING_RE = Rx('^(?:#+\\s+)?(?:\\d+(?:\\.\\d+)*\\s*)?[A-Z]?\\d+(?:\\s*[A-Z0-9./×\\-]{2,})+$')
    DATE_LIKE_RE = Rx('\\b\\d{4}[-—–/]\\d{1,2}(?:[-—–/]\\d{1,2})?\\b')
    METADATA_PARAM_RE = Rx('(?:分类号|发布|实施|代替|计划项目代号|标准编号|版本日期)', True)
    TEMPLATE_SUMMARY_RE = Rx('(?:当前识别为|文本层极弱|建议先进行 OCR 后再做稳定抽取)')
    LONG_SENTENCE_TAG_RE = Rx('[，、；。,:：]')
    COUNT_ONLY_SUMMARY_SIGNAL_RE = Rx('(?:当前识别为|已建立\\s*\\d+|已抽取\\s*\\d+|已识别\\s*\\d+)')
    GENERIC_CHAPTER_TITLE_RE = Rx('^(?:章节主题(?:（原文：.+）)?|Seite\\s*\\d+|Page\\s*\\d+)$', True)
    LOW_SIGNAL_CHAPTER_SUMMARY_RE = Rx('(?:^当前仅稳定识别到|正文仍然较少|当前细节仍以原文为准|已识别到原文正文，当前细节仍以原文为准)')
    LLM_STUB_RE = Rx('^(?:文档可提取内容极少|当前仅识别到|由于原始文本层缺失|未获得实质性|无法从现有原料|当前识别为|已建立\\d+个|已抽取\\d+条)')


class Tags:
    """Fixed values of the tags."""

    STANDARD_FAMILY_RE = Rx('^(DIN EN ISO|DIN ISO|DIN EN|DIN|EN|ISO|SN|SEW|DVS|AD)', True)
    APPLICATION_HINT_RE = Rx('(?:适用范围|应用范围|应用场景|用途|application|scope|anwendungsbereich)\\s*[:：]?\\s*(.+)', True)
    CERTIFICATION_RE = Rx('\\b(?:CE|UL|CSA|ATEX|IECEx|RoHS|REACH|CCC|TUV|TÜV|FDA|EHEDG|3-A)\\b', True)
    LOW_SIGNAL_PARAMETER_RE = Rx('^(?:-|\\(?[A-Z]\\)?|DN|d\\s*\\d+\\)?|l\\s*\\d+|s\\d*|b|h|w)$', True)
    NUMBER_HEAVY_RE = Rx('(?:\\d+[.)/]?\\s*){2,}')
    ABBREV_HEAVY_RE = Rx('(?:\\b[a-z]{1,3}\\b\\s*){2,}', True)
    PARAMETER_TAG_PATTERNS = [
        (Rx('\\b(?:pressure|druck|betriebsdruck|working pressure|psi|bar)\\b', True), '压力'),
        (Rx('\\b(?:weight|gewicht)\\b', True), '重量'),
        (Rx('\\b(?:radius|biegeradius|halbmesser)\\b', True), '半径'),
        (Rx('\\b(?:length|länge|laenge)\\b', True), '长度'),
        (Rx('\\b(?:width|breite)\\b', True), '宽度'),
        (Rx('\\b(?:height|höhe|hoehe)\\b', True), '高度'),
        (Rx('\\b(?:temperature|temperatur)\\b', True), '温度'),
        (Rx('\\b(?:tolerance|abweichung)\\b', True), '公差'),
        (Rx('\\b(?:schl(?:u|ü|ue)sselweite)\\b', True), '尺寸'),
        (Rx('\\b(?:size|größe|grösse|groesse|nenngröße|nenngroesse|dimension)\\b', True), '尺寸'),
        (Rx('\\b(?:thickness|wanddicke|wall thickness)\\b', True), '厚度'),
    ]
    SERIES_NOISE_RE = Rx('(产品样本|产品目录|catalog|brochure|sample)', True)


class Refine:
    """Fixed values of the structure refinement."""

    MONTH_YEAR_RE = Rx('^(?:january|february|march|april|may|june|july|august|september|october|november|december|januar|februar|märz|maerz|april|mai|juni|juli|august|september|oktober|november|dezember)\\s+\\d{4}$', True)
    PAGE_NOISE_RE = Rx('^(?:page|seite|supersedes|contents|index)$', True)
    PURE_NUMBER_RE = Rx('^\\d+(?:\\.\\d+)*$')
    ICS_RE = Rx('^ICS\\s+\\d+(?:\\.\\d+)*$', True)
    DIMENSION_CODE_RE = Rx('^(?:G|R|DN)\\s*\\d+(?:\\s+\\d+/\\d+)?$', True)
    COPYRIGHT_RE = Rx('^(?:©|copyright\\b|all rights reserved\\b)', True)
    NOISE_MARKER_RE = Rx('^(?:bearbeitet|edited|draft|status)$', True)
    SPLIT_TOKEN_RE = Rx('^[A-Z](?:\\s*/\\s*[A-Z])+(?:\\s*/\\s*[A-Z])*$')
    TRAILING_FRAGMENT_RE = Rx('^[a-z(].*[.;]?$')
    UNIT_FRAGMENT_RE = Rx('^(?:mm|cm|m|bar|psi|kg|g|°c|℃|%|a/m)$', True)
    MATRIX_FRAGMENT_RE = Rx('^(?:[A-Z0-9]+\\s*/\\s*)+[A-Z0-9.]+$')
    REPEATED_NUMBER_FRAGMENT_RE = Rx('^(?:\\d+[.,]?\\d*\\s*){3,}$')
    SHORT_TOKEN_RE = Rx('^[A-Z]{1,3}$')
    LETTER_RANGE_RE = Rx('^[A-Z](?:\\s*-\\s*[A-Z])+$')
    VALUE_FRAGMENT_RE = Rx('^(?:[+\\-]|≤|≥|<|>)?\\s*(?:DN\\s*)?\\d+(?:[.,]\\d+)?\\s*%?$', True)
    LEADING_CONJUNCTION_RE = Rx('^(?:and|und|or|oder)\\b', True)
    SENTENCE_VERB_RE = Rx('\\b(?:beträgt|ist|sind|muss|müssen|werden|wird|can|shall|must|used|pointing|given)\\b', True)


class Ocr:
    """Fixed values of the OCR page evaluation."""

    SECTION_SIGNAL_RE = Rx('(?:^\\d+(?:\\.\\d+){0,4}\\s+\\S+|^第\\s*\\d+\\s*(?:章|节|部分)?|^(?:范围|要求|标记示例|引用文件|结构和规格尺寸)\\b)')
    STANDARD_SIGNAL_RE = Rx('\\b(?:DIN|EN|ISO|SN|SEW|DVS|AD|TRbF|GB|CB)\\s*[0-9][0-9A-Za-z./\\-—–]*\\b')
    TABLE_SIGNAL_RE = Rx('(?:表|图|Table|Figure|Fig\\.?|Tabelle)\\s*\\d+', True)
    CONTENT_CHAR_RE = Rx('[A-Za-z0-9一-鿿]')


class Local:
    """Fixed values of the localisation."""

    CJK_RE = Rx('[一-鿿]')
    LATIN_RE = Rx('[A-Za-zÄÖÜäöüß]')
    SYMBOL_NOISE_RE = Rx('[Ω⋅]')
    TECH_TOKEN_RE = Rx('^(?:[A-Za-z]{1,6}\\d{0,3}|\\d{0,3}[A-Za-z]{1,6}|[A-Za-z]\\d{1,3})$')
    TRANSLATION_PATTERNS = [
        (Rx('(?:ma(?:ß|ss)e)\\s+(?:und|&)\\s+(?:bezeichnungsbeispiel|designation example)', True), '尺寸与命名示例'),
        (Rx('(?:werkstoff)\\s+(?:und|&)\\s+(?:ausf(?:ü|ue)hrung|construction|design)', True), '材料与结构'),
        (Rx('(?:zitierte?\\s+normen|cited?\\s+standards?|referenced?\\s+standards?)', True), '引用标准'),
        (Rx('(?:weitere?\\s+normen|additional\\s+standards?|other\\s+standards?)', True), '其他标准'),
        (Rx('(?:innenschicht|inner\\s*layer|lining)', True), '内层'),
        (Rx('(?:au(?:ß|ss)enschicht|outer\\s*layer|cover)', True), '外层'),
        (Rx('(?:kennzeichnung|marking|labeling)', True), '标识'),
        (Rx('(?:anwendungsbereich|application(?:\\s+range)?|scope)', True), '适用范围'),
        (Rx('(?:k(?:leinster)?\\s*biegeradius|bend radius|radius)', True), '弯曲半径'),
        (Rx('(?:nenn(?:gr(?:ö|oe)ße|groesse)|nominal size)', True), '公称尺寸'),
        (Rx('(?:ma(?:ß|ss)e|dimension(?:s)?|size)', True), '尺寸'),
        (Rx('(?:bezeichnungsbeispiel|designation example)', True), '命名示例'),
        (Rx('(?:werkstoff|material)', True), '材料'),
        (Rx('(?:ausf(?:ü|ue)hrung|construction|design)', True), '结构'),
        (Rx('(?:norm(?:en)?|standard(?:s)?)', True), '标准'),
        (Rx('(?:temperatur|temperature)', True), '温度'),
        (Rx('(?:druck|pressure|betriebsdruck)', True), '压力'),
        (Rx('(?:gewicht|weight)', True), '重量'),
        (Rx('(?:l(?:ä|ae)nge|length)', True), '长度'),
        (Rx('(?:breite|width)', True), '宽度'),
        (Rx('(?:h(?:ö|oe)he|height)', True), '高度'),
        (Rx('(?:dicke|thickness)', True), '厚度'),
        (Rx('(?:general|allgemeine(?:s|n)?)\\s*(?:requirement|anforderung|provision)', True), '一般要求'),
        (Rx('(?:technical\\s+)?requirement(?:s)?|anforderung', True), '技术要求'),
        (Rx('(?:scope|anwendungsbereich|geltungsbereich)', True), '范围'),
        (Rx('(?:normative\\s+reference|normative\\s+verweis|referenced\\s+standard)', True), '规范性引用文件'),
        (Rx('(?:term|definition|begriff)', True), '术语和定义'),
        (Rx('(?:classification|classify|einteilung|klassifikation)', True), '分类'),
        (Rx('(?:type\\s+designation|bezeichnung|designation)', True), '型号命名'),
        (Rx('(?:marking|kennzeichnung|label(?:ing)?)', True), '标志'),
        (Rx('(?:packaging|packing|verpackung)', True), '包装'),
        (Rx('(?:transport|transportation|bef(?:ö|oe)rderung)', True), '运输'),
        (Rx('(?:storage|storing|lagerung)', True), '贮存'),
        (Rx('(?:sampling|probenahme|sampling)', True), '取样'),
        (Rx('(?:test\\s+method|pr(?:ü|ue)fverfahren|testing)', True), '试验方法'),
        (Rx('(?:inspection|pr(?:ü|ue)fung|examination)', True), '检验规则'),
        (Rx('(?:table\\s+\\d+|tabular)', True), '表格'),
        (Rx('(?:list\\s+of|verzeichnis)', True), '列表'),
        (Rx('(?:dimension|dimensionen|abmessung)', True), '尺寸表'),
        (Rx('(?:chemical\\s+composition|chemische\\s+zusammensetzung)', True), '化学成分'),
        (Rx('(?:mechanical\\s+property|mechanische\\s+eigenschaft)', True), '力学性能'),
        (Rx('(?:physical\\s+property|physikalische\\s+eigenschaft)', True), '物理性能'),
        (Rx('(?:pr(?:ü|ue)fung|inspection|test)', True), '检验'),
        (Rx('(?:anwendung|application)', True), '应用'),
        (Rx('(?:montage|installation)', True), '安装'),
        (Rx('(?:wartung|maintenance)', True), '维护'),
    ]


class Guard:
    """Fixed values of the standard codes."""

    STANDARD_CODE_TOKEN_RE = Rx('\\b([A-Z]{2,4})(?:[/_\\-\\s]?([A-Z]))?[\\s_]*(\\d+(?:\\.\\d+)*)\\s*[-—–_.一]\\s*(\\d{2,4}(?:-\\d{2})?)\\b', True)


class Markdown:
    """Fixed values of the rendering."""

    SYNTHETIC_TABLE_TITLE_RE = Rx('^第\\d+页表\\d+$')
    LOW_SIGNAL_TABLE_TITLE_RE = Rx('^(?:zitierte normen|引用标准|references|reference standards|weitere normen|further standards)$', True)
    COMMA_FRAGMENT_TABLE_TITLE_RE = Rx('.+,\\s*$')
