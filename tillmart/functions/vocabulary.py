"""Item texts and keywords that decide an item's flags.

Matching is exact and case-sensitive. Each flag list is what was seen in the
feed plus what was added by hand; a text may be in more than one list.
"""

# Fixed values.
UNKNOWN_TEXTS = ["?", "??", "???", "Incorrect stock entry.", "can't find", "nan"]

# Fixed values.
ERROR_TEXTS_SEEN = [
    "check", "damaged", "wet/rusty", "found", "lost in space",
    "wrongly marked. 23343 in box", "wrongly marked 23343",
    "wrongly coded 23343", "wrongly coded-23343", "Found", "damages",
    "damages/display", "WET/MOULDY", "damages?", "Damaged", "wet",
    "wet rusty", "wrongly marked", "broken", "CHECK", "wrong barcode",
    "?missing", "smashed", "missing", "???lost", "faulty", "Missing",
    "?lost", "wrongly sold (22719) barcode", "wrong code?", "wet boxes",
    "?? missing", "missing?", "lost", "mouldy, thrown away.",
    "mouldy, unsaleable.", "damages/showroom etc", "wrong barcode (22467)",
    "wrong code", "FOUND", "Wrongly mrked had 85123a in box", "water damage",
    "rusty throw away", "Crushed", "mouldy", "20713 wrongly marked",
    "wrongly coded 20713", "sold with wrong barcode", "Sale error",
    "Found by jackie", "found some more on shelf", "damages/dotcom?",
    "damaged stock", "found box", "throw away", "Wet pallet-thrown away",
    "wet pallet", "???missing", "????missing", "Water damaged",
    "damages/credits from ASOS.", "Unsaleable, destroyed.", "crushed",
    "crushed ctn", "cracked", "Damages/samples", "water damaged",
    "wet damaged", "wet?", "damages wax", "stock creditted wrongly",
    "????damages????", "check?", "wrongly marked carton 22804", "Damages",
    "samples/damages", "DAMAGED", "wrongly sold as sets",
    "wrongly sold sets", "Found in w/hse", "lost??", "stock check",
    "crushed boxes",
]

# Fixed values.
ERROR_TEXTS_ADDED = [
    "on cargo order", "test", "barcode problem", "mixed up", "michel oops",
    "printing smudges/thrown away", "had been put aside",
    "rusty thrown away", "incorrectly made-thrown away.", "Breakages",
    "counted", "Had been put aside.", "returned", "thrown away",
    "mystery! Only ever imported 1800", "Dagamed", "code mix up? 84930",
    "Printing smudges/thrown away", "came coded as 20713",
    "incorrect stock entry.", "thrown away-can't sell",
    "Thrown away-rusty", "Thrown away.", "Given away",
    "historic computer difference?....se",
    "alan hodge cant mamage this section", "thrown away-can't sell.",
    "label mix up", "sold in set?", "mix up with c",
]

# Fixed values.
SPECIAL_TEXTS_SEEN = [
    "dotcom", "Amazon Adjustment", "sold as set on dotcom",
    "Sold as 1 on dotcom", "rcvd be air temp fix for dotcom sit",
    "re dotcom quick fix.", "sold as set on dotcom and amazon", "showroom",
    "amazon adjust", "Amazon", "John Lewis",
    "Dotcomgiftshop Gift Voucher £100.00", "Dotcom sold in 6's", "amazon",
    "amazon sales", "AMAZON", "CORDIAL JUG",
    "allocate stock for dotcom orders ta", "website fixed", "dotcom adjust",
    "sold as set/6 by dotcom", "sold as set by dotcom", "Dotcom sales",
    "dotcom sales", "Dotcom", "dotcomstock", "FBA", "Dotcom set",
    "dotcom sold sets", "Amazon sold sets", "ebay",
]

# Fixed values.
SPECIAL_TEXTS_ADDED = [
    "MIA", "?display?", "Amazon Adjustment",
    "Lighthouse Trading zero invc incorr",
    "Dotcomgiftshop Gift Voucher £100.00", "sold as set?",
    "High Resolution Image", "John Lewis", "Bank Charges",
    "Next Day Carriage",
]

# Fixed values.
MODIFICATION_TEXTS_SEEN = [
    "Adjustment", "adjustment", "taig adjust no stock", "Show Samples",
    "samples", "sold as 1", "OOPS ! adjustment", "taig adjust",
    "reverse 21/5/10 adjustment", "sold as 22467",
    "add stock to allocate online orders", "temp adjustment", "mailout ",
    "mailout", "re-adjustment", "did  a credit  and did not tick ret",
    "incorrectly credited C550456 see 47", "reverse previous adjustment",
    "adjust", "label mix up", "?sold as sets?", "? sold as sets?",
]

# Fixed values.
MODIFICATION_TEXTS_ADDED = [
    "Adjustment", "OOPS ! adjustment", "reverse 21/5/10 adjustment",
    "reverse previous adjustment", "marked as 23343",
    "incorrectly put back into stock", "Not rcvd in 10/11/2010 delivery",
    "Display", "Had been put aside.", "sold as set by dotcom",
    "add stock to allocate online orders",
    "allocate stock for dotcom orders ta", "for online retail orders",
    "Marked as 23343",
]


def distinct(*lists: list[str]) -> list[str]:
    """Lists joined in order, each value once."""
    return list(dict.fromkeys(value for values in lists for value in values))


FLAG_TEXTS = {
    "is_unknown_item": UNKNOWN_TEXTS,
    "is_special_item": distinct(SPECIAL_TEXTS_SEEN, SPECIAL_TEXTS_ADDED),
    "is_modification_item": distinct(MODIFICATION_TEXTS_SEEN, MODIFICATION_TEXTS_ADDED),
    "is_error_item": distinct(ERROR_TEXTS_SEEN, ERROR_TEXTS_ADDED),
}

ADDED_TEXTS = {
    "error": ERROR_TEXTS_ADDED,
    "special": SPECIAL_TEXTS_ADDED,
    "modification": MODIFICATION_TEXTS_ADDED,
}

# Fixed values. A lower-cased text that contains a keyword is of that class;
# the first class that matches wins.
CLASS_KEYWORDS = {
    "error": [
        "check", "damage", "wet", "lost", "found", "error", "wrong",
        "faulty", "mouldy", "smashed", "broken", "crush", "crack",
        "unsaleable", "missing", "throw away",
    ],
    "special": [
        "dotcom", "amazon", "fba", "ebay", "john lewis", "showroom",
        "voucher", "cordial jug", "website",
    ],
    "modification": [
        "adjust", "sample", "sold as", "mailout", "allocate", "temp",
        "credit", "sale", "re-adjustment", "label mix up",
    ],
}

# The closed domain of item categories.
CATEGORIES = [
    "HOME DECOR", "KITCHENWARE", "TABLEWARE", "GIFT ITEMS", "FURNITURE",
    "TOYS", "CANDLES", "JEWELRY", "TEXTILES", "GARDENING", "BATHROOM",
    "STATIONERY", "BAGS", "LIGHTING", "CRAFTS", "HOLIDAY", "OUTDOOR",
    "TOOL & DIY", "SPORTS", "STORAGE", "TRAVEL", "BEAUTY", "BOOKS", "GAMES",
    "ORGANIZERS", "TABLE LINEN", "CHILDREN", "CERAMICS", "CLOTHING",
    "PLANTS & FLOWERS", "OTHERS",
]

OTHER_CATEGORY = "OTHERS"

# Word -> category. The first rule with a word in the family text wins.
CATEGORY_RULES = [
    ("CHRISTMAS", "HOLIDAY"), ("EASTER", "HOLIDAY"), ("ADVENT", "HOLIDAY"),
    ("CANDLE", "CANDLES"), ("T-LIGHT", "CANDLES"), ("CANDLES", "CANDLES"),
    ("NECKLACE", "JEWELRY"), ("BRACELET", "JEWELRY"), ("EARRINGS", "JEWELRY"),
    ("RING", "JEWELRY"), ("LANTERN", "LIGHTING"), ("LAMP", "LIGHTING"),
    ("LIGHTS", "LIGHTING"), ("NAPKINS", "TABLE LINEN"),
    ("TABLECLOTH", "TABLE LINEN"), ("TEACUP", "TABLEWARE"),
    ("PLATE", "TABLEWARE"), ("BOWL", "TABLEWARE"), ("MUG", "TABLEWARE"),
    ("CAKE", "KITCHENWARE"), ("TEAPOT", "KITCHENWARE"),
    ("JAM", "KITCHENWARE"), ("CUTLERY", "KITCHENWARE"), ("BAG", "BAGS"),
    ("PURSE", "BAGS"), ("SUITCASE", "TRAVEL"), ("PASSPORT", "TRAVEL"),
    ("PENCIL", "STATIONERY"), ("CARD", "STATIONERY"),
    ("NOTEBOOK", "STATIONERY"), ("BOOK", "BOOKS"), ("GAME", "GAMES"),
    ("PLAYING", "GAMES"), ("DOLL", "TOYS"), ("TOY", "TOYS"),
    ("WIDGET", "TOYS"), ("CHILDRENS", "CHILDREN"), ("BABY", "CHILDREN"),
    ("CUSHION", "TEXTILES"), ("QUILT", "TEXTILES"), ("SCARF", "CLOTHING"),
    ("APRON", "CLOTHING"), ("SOAP", "BEAUTY"), ("BATH", "BATHROOM"),
    ("TOWEL", "BATHROOM"), ("PLANTER", "GARDENING"), ("GARDEN", "GARDENING"),
    ("FLOWER", "PLANTS & FLOWERS"), ("ROSE", "PLANTS & FLOWERS"),
    ("PARASOL", "OUTDOOR"), ("PICNIC", "OUTDOOR"), ("BALL", "SPORTS"),
    ("ROD", "SPORTS"), ("BOX", "STORAGE"), ("TIN", "STORAGE"),
    ("CABINET", "FURNITURE"), ("STOOL", "FURNITURE"),
    ("HOLDER", "ORGANIZERS"), ("HOOK", "ORGANIZERS"), ("CERAMIC", "CERAMICS"),
    ("KNITTING", "CRAFTS"), ("SEWING", "CRAFTS"), ("BOLT", "TOOL & DIY"),
    ("GEAR", "TOOL & DIY"), ("ANVIL", "TOOL & DIY"), ("GIFT", "GIFT ITEMS"),
    ("HEART", "HOME DECOR"), ("FRAME", "HOME DECOR"), ("SIGN", "HOME DECOR"),
]
