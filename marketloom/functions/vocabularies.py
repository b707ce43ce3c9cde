"""Vocabularies: canonical values and their synonyms."""

from __future__ import annotations

# What the text of each attribute may hold.
CASE_MATERIAL = {
    "Ceramic, Metal": ["Ceramic, Metal", "Ceramos"],
    "Diamond, Gemstones": ["Diamond, Gemstones", "diamond", "diamonds", "diamond-set"],
    "Gemstones": ["Gemstones", "emerald", "topaz", "sapphires", "amethyst", "rubies", "ruby", "gemstones", "gem-set"],
    "ADLC": ["ADLC"],
    "Aluminum": ["Aluminum", "aluminium"],
    "Bronze": ["Bronze"],
    "Ceramic": ["Ceramic"],
    "Cermet": ["Cermet"],
    "Composite": ["Composite"],
    "DLC": ["DLC"],
    "Magnesium": ["Magnesium"],
    "Palladium": ["Palladium"],
    "Polymer": ["Polymer", "Breitlight", "Titaplast"],
    "PVD": ["PVD"],
    "Rose Gold": ["Rose Gold", "pink gold", "red gold", "orange gold", "5N", "6N", "sedna", "everose", "everrose", "king gold"],
    "Rubber": ["Rubber"],
    "Sapphire": ["Sapphire"],
    "Silver": ["Silver"],
    "Steel": ["Steel", "omegasteel"],
    "Tantalum": ["Tantalum"],
    "Titanium": ["Titanium", "titalyt", "Ceratanium"],
    "Tungsten": ["Tungsten"],
    "Two-Tone": ["Two-Tone", "two tone", "gold and stainless", "gold and steel", "gold & steel"],
    "White Gold": ["White Gold", "canopus gold"],
    "Zalium": ["Zalium"],
    "Zirconium": ["Zirconium"],
    "Gold": ["Gold", "yellow gold", "moonshine gold", "beige gold", "honeygold", "honey gold"],
}

DIAL_COLOR = {
    "Diamond, Gemstones": ["Diamond, Gemstones", "diamond", "diamonds", "diamond-set"],
    "Gemstones": ["Gemstones", "emerald", "topaz", "sapphire", "amethyst", "rubies", "ruby", "gemstones", "gem-set"],
    "Silver": ["Silver", "Silvered", "argente", "platinum"],
    "Rose Gold": ["Rose Gold", "rose"],
    "Steel": ["Steel"],
    "Bronze": ["Bronze"],
    "Red": ["Red", "burgundy"],
    "Orange": ["Orange"],
    "Yellow": ["Yellow", "White Grape"],
    "Green": ["Green", "olive", "mint"],
    "Blue": ["Blue", "turquoise", "Ice Blue", "aqua", "navy", "midnight"],
    "Purple": ["Purple", "aubergine", "violet", "lavender", "Red Grape"],
    "Black": ["Black", "onyx"],
    "Gray": ["Gray", "slate", "charcoal", "grey", "Anthracite", "Ruthenium"],
    "White": ["White", "ivory", "cream"],
    "Salmon": ["Salmon"],
    "Brown": ["Brown", "chocolate", "beige", "tan", "khaki", "walnut", "Bwoodrown", "Havana", "Taupe"],
    "Pink": ["Pink", "ruby"],
    "Multi": ["Multi", "multiple", "Multi-Color", "Cloisonn", "motif", "Multi-Coloured", "Camouflage", "floral", "pattern"],
    "Transparent": ["Transparent", "skeleton", "openwork", "skeletonized"],
    "Mother of Pearl": ["Mother of Pearl", "MOP", "Mother-of-pearl"],
    "Pearl": ["Pearl"],
    "Champagne": ["Champagne"],
    "Meteorite": ["Meteorite"],
    "Rhodium": ["Rhodium"],
    "Sundust, Rose Gold": ["Sundust, Rose Gold", "sundust"],
    "Copper": ["Copper"],
    "Gold": ["Gold", "yellow gold", "moonshine gold", "beige gold", "honeygold", "honey gold", "golden"],
}

CONDITION = {
    "Pre-Owned, Manufacturer Refurbished": ["Pre-Owned, Manufacturer Refurbished", "Manufacturer Refurbished"],
    "Pre-Owned, Seller Refurbished": ["Pre-Owned, Seller Refurbished", "Seller Refurbished"],
    "Pre-Owned, Vintage": ["Pre-Owned, Vintage", "Vintage", "Circa 1"],
    "Pre-Owned": ["Pre-Owned", "very good", "good", "fair", "pre-owned", "preowned", "used", "barely worn", "worn once", "worn twice", "worn three", "only worn", "almost new", "like new", "near new", "excellent condition", "excellent overall condition", "good condition", "great condition", "amazing condition", "Fantastic condition", "Near-mint condition", "Near mint condition", "Outstanding", "good overall condition", "great overall condition", "superb", "strong condition", "light signs of wear", "poor", "previously worn", "as new"],
    "Modified": ["Modified", "modified", "aftermarket", "custom"],
    "New": ["New", "unworn", "brand new", "never worn", "new-in-box", "Pre-Owned/Unworn", "mint condition"],
    "Incomplete": ["Incomplete", "parts"],
    "Unspecified": ["Unspecified"],
}

MOVEMENT = {
    "Automatic": ["Automatic", "self-winding", "perpetual", "self winding"],
    "Manual winding": ["Manual winding", "manual", "hand winding", "hand-wound"],
    "Kinetic": ["Kinetic"],
    "Quartz": ["Quartz", "battery"],
    "Solar": ["Solar"],
    "Spring Drive": ["Spring Drive"],
}

STYLE = {
    "Sport": ["Sport", "sports"],
    "Dive": ["Dive", "Diver", "Diving", "Dive Watch", "Diving Watch", "Diver Watch"],
    "Chronograph": ["Chronograph", "stopwatch"],
    "Military / Field": ["Military / Field", "Military", "Field", "Military Watch", "Field Watch", "Field / Military", "field/military watches"],
    "GMT": ["GMT", "GMT Watch", "Greenwich Mean Time Watch", "GMT watches", "Greenwich Mean Time"],
    "Dress": ["Dress", "Dress Watch", "dress watches"],
    "Aviator": ["Aviator", "Aviator Watch", "aviator watches", "flieger watches"],
    "Atomic Radio Controlled": ["Atomic Radio Controlled", "Atomic Radio Controlled Watch", "Atomic watch", "radio controlled watch", "radio watch", "atomic radio"],
    "GPS": ["GPS Watch Watch"],
    "Smartwatch": ["Smartwatch", "Smart Watch", "Apple Watch", "mobile watch", "wearable tech"],
    "Pilot": ["Pilot", "Pilot Watch"],
    "Skeleton": ["Skeleton", "Skeleton Watch", "openwork", "skeleton dial", "skeletonized watch", "transparent", "open work"],
    "Racing / Driving": ["Racing / Driving", "Racing", "Driving", "Racing Watch", "Driving Watch", "motorsport watch", "car watch"],
}

NUMERALS = {
    "Arabic numerals": ["Arabic numerals", "arabic dial watch", "arabic", "arabic numerals", "Breguet"],
    "Roman numerals": ["Roman numerals", "roman"],
    "Chinese numerals": ["Chinese numerals", "chinese"],
    "Hebrew numerals": ["Hebrew numerals", "hebrew"],
    "No numerals": ["bars", "stick", "dot", "baton", "none", "diamond", "gem-set"],
    "No markers": ["No markers"],
}

BRACELET_MATERIAL = {
    "Acrylic": ["Acrylic"],
    "Aluminum": ["Aluminum", "aluminum", "aluminium"],
    "Alligator, Leather": ["Alligator, Leather", "alligator", "alligator leather", "aligator", "gator"],
    "Anthracite": ["Anthracite"],
    "Bronze": ["Bronze"],
    "Buffalo, Leather": ["Buffalo, Leather", "buffalo"],
    "Calfskin, Leather": ["Calfskin, Leather", "calf", "calfskin"],
    "Canvas, Fabric": ["Canvas, Fabric", "canvas"],
    "Carbon": ["Carbon"],
    "Ceramic": ["Ceramic"],
    "Crocodile, Leather": ["Crocodile, Leather", "crocodile", "croc leather", "croc"],
    "Crystal": ["Crystal"],
    "Denim, Fabric": ["Denim, Fabric", "denim", "jean"],
    "Diamond, Gemstones": ["Diamond, Gemstones", "diamond", "diamonds"],
    "DLC": ["DLC"],
    "Eel, Leather": ["Eel, Leather", "eel"],
    "Fabric": ["Fabric", "textile", "cloth"],
    "Gemstones": ["Gemstones", "gem-set", "rubies", "emerald", "topaz", "ruby", "amethyst"],
    "Kevlar": ["Kevlar"],
    "Kudu, Leather": ["Kudu, Leather", "kudu"],
    "Leather": ["Leather", "leather"],
    "Lizard, Leather": ["Lizard, Leather", "lizard"],
    "Nylon, Fabric": ["Nylon, Fabric", "nylon"],
    "Platinum": ["Platinum"],
    "Polymer": ["Polymer", "Breitlight", "Titaplast", "elastomer"],
    "PVD": ["PVD"],
    "Rose Gold": ["Rose Gold", "pink gold", "red gold", "orange gold", "5N", "6N", "sedna", "everose", "everrose", "king gold"],
    "Rubber": ["Rubber"],
    "Sapphire": ["Sapphire"],
    "Satin, Fabric": ["Satin, Fabric", "satin"],
    "Snakeskin, Leather": ["Snakeskin, Leather", "snake", "snakeskin"],
    "Steel": ["Steel", "stainless", "oystersteel"],
    "Stringray, Leather": ["Stringray, Leather", "stingray", "Galuchat"],
    "Tantalum": ["Tantalum"],
    "Titanium": ["Titanium", "titalyt", "Ceratanium"],
    "Two-Tone": ["Two-Tone", "two tone", "gold and stainless", "gold and steel", "gold & steel"],
    "White Gold": ["White Gold", "canopus"],
    "Wood": ["Wood", "bark"],
    "Gold, Steel": ["Gold, Steel", "Rolesor"],
    "Gold": ["Gold", "yellow gold", "moonshine gold", "beige gold", "honeygold", "honey gold"],
}

BRACELET_COLOR = {
    "Black": ["Black", "onyx"],
    "Blue": ["Blue", "turquoise", "Ice Blue", "aqua", "navy", "midnight"],
    "Bronze": ["Bronze"],
    "Brown": ["Brown", "chocolate", "beige", "tan", "wood", "taupe"],
    "Diamond": ["Diamond", "diamond", "diamonds", "diamond-set"],
    "Gray": ["Gray", "grey", "slate", "charcoal"],
    "Green": ["Green", "emerald"],
    "Multi": ["Multi", "multicolor", "artistic", "pattern", "camo", "multi"],
    "Orange": ["Orange"],
    "Pearl": ["Pearl"],
    "Pink": ["Pink"],
    "Purple": ["Purple", "aubergine", "violet", "lavender"],
    "Red": ["Red", "burgundy"],
    "Rose Gold": ["Rose Gold", "pink gold", "red gold", "orange gold", "5N", "6N", "sedna", "everose", "everrose", "king gold", "rose"],
    "Silver": ["Silver", "Silvered", "argente"],
    "Steel": ["Steel"],
    "Two-Tone": ["Two-Tone"],
    "White Gold": ["White Gold", "canopus"],
    "White": ["White", "ivory", "cream"],
    "Gold": ["Gold", "yellow gold", "moonshine gold", "beige gold", "honeygold", "honey gold"],
    "Yellow": ["Yellow"],
    "Interchangable": ["Interchangable"],
}

CLASP_TYPE = {
    "Pin Buckle, Buckle": ["Pin Buckle, Buckle", "pin", "tang", "ardiillon", "tang-type", "prong buckle"],
    "Sliding Buckle, Buckle": ["Sliding Buckle, Buckle", "sliding"],
    "Hidden Clasp, Folding Clasp": ["Hidden Clasp, Folding Clasp", "hidden"],
    "Butterfly Clasp, Folding Clasp": ["Butterfly Clasp, Folding Clasp", "double fold", "double folding", "butterfly"],
    "Triple Folding Clasp, Folding Clasp": ["Triple Folding Clasp, Folding Clasp", "triple"],
    "Velcro": ["Velcro"],
    "Non-closure": ["Non-closure", "nonclosure"],
    "NATO": ["NATO"],
    "Buckle": ["Buckle"],
    "Folding Clasp": ["Folding Clasp", "fold", "folding", "fold-over", "t-fit", "Oysterlock"],
}

FEATURES = {
    "24-Hour Indication": ["24-Hour Indication", "24 hour"],
    "3D Moon Phases": ["3D Moon Phases", "3-d moon", "3d moon", "3d moonphase"],
    "4-Year Calendar": ["4-Year Calendar", "4 year calendar"],
    "Alarm": ["Alarm"],
    "Altitude Indicator": ["Altitude Indicator", "altitude"],
    "AM/PM Indication": ["AM/PM Indication", "am pm", "am/pm"],
    "Annual Calendar": ["Annual Calendar", "yearly calendar", "year calendar"],
    "Anti‑magnetic": ["Anti‑magnetic", "antimagnetic"],
    "Bi‑directional rotating bezel": ["Bi‑directional rotating bezel", "bidirectional rotating", "bidirectional bezel"],
    "Calendar": ["Calendar"],
    "Carousel": ["Carousel"],
    "Central Minutes": ["Central Minutes", "central mins", "center minutes"],
    "Central Seconds": ["Central Seconds", "center seconds"],
    "Chain & Fusée": ["Chain & Fusée", "chain fusee", "fusee & chain", "fusee", "chain and fusee", "fusee and chain"],
    "Chiming Clock": ["Chiming Clock", "striking", "chime", "chiming", "sonnerie"],
    "Chinese Calendar": ["Chinese Calendar"],
    "Chronograph": ["Chronograph"],
    "Chronometer": ["Chronometer"],
    "Co-Axial Escapement": ["Co-Axial Escapement"],
    "Column Wheel": ["Column Wheel"],
    "Compass": ["Compass"],
    "Complete Calendar": ["Complete Calendar"],
    "Constant Force": ["Constant Force"],
    "Date": ["Date"],
    "Day / Night Indication": ["Day / Night Indication", "day-night", "day night", "night and day"],
    "Day‑Date": ["Day‑Date", "day date", "day and date", "date-day", "day+date"],
    "Depth Gauge": ["Depth Gauge", "depth"],
    "Diamonds": ["Diamonds", "diamond"],
    "Double Balance": ["Double Balance"],
    "Equation of Time": ["Equation of Time"],
    "Flashing Seconds": ["Flashing Seconds", "foudroyante"],
    "Flyback": ["Flyback", "flyback chronograph"],
    "Gemstones": ["Gemstones", "pave", "diamond", "gem-set", "gemset"],
    "GMT": ["GMT", "Greenwich Mean Time", "UTC"],
    "Grande Sonnerie": ["Grande Sonnerie"],
    "Helium Escape Valve": ["Helium Escape Valve", "HEV", "helium escape", "escape valve", "helium valve"],
    "Hours": ["Hours", "hour", "HMS"],
    "Jumping Hours": ["Jumping Hours", "jumping hour"],
    "Jumping Minutes": ["Jumping Minutes", "jumping min"],
    "Jumping Seconds": ["Jumping Seconds", "jumping sec"],
    "Leap Year": ["Leap Year", "leapyear"],
    "Limited edition": ["Limited edition", "limited", "boutique edition", "one-of-a-kind", "unique piece"],
    "Luminous": ["Luminous"],
    "Master Chronometer Certified": ["Master Chronometer Certified", "Master Chronometer", "METAS", "Master Chrono"],
    "Minute Repeater": ["Minute Repeater", "repeating minutes", "minute repeat"],
    "Minutes": ["Minutes", "HMS"],
    "Month": ["Month", "months"],
    "Monopusher": ["Monopusher", "monopoussoir"],
    "Moon Phases": ["Moon Phases", "moonphase", "moon phase", "moon phase", "moon"],
    "Moon Position / Rising Time": ["Moon Position / Rising Time", "moon position", "moon rising"],
    "Perpetual Calendar": ["Perpetual Calendar"],
    "Petite Sonnerie": ["Petite Sonnerie", "Petit Sonnerie"],
    "Power Reserve Indication": ["Power Reserve Indication", "power reserve indicator"],
    "Pulsometer": ["Pulsometer"],
    "Rattrapante": ["Rattrapante", "split-seconds"],
    "Regatta Timer": ["Regatta Timer", "Regatta timing", "regatta"],
    "Retrograde Date": ["Retrograde Date"],
    "Retrograde Display": ["Retrograde Display", "retrograde"],
    "Retrograde Hours": ["Retrograde Hours", "Retrograde Hour"],
    "Retrograde Minutes": ["Retrograde Minutes", "Retrograde Minute"],
    "Retrograde Seconds": ["Retrograde Seconds", "Retrograde Second"],
    "Screw‑in crown": ["Screw‑in crown", "screw-down", "screw-in"],
    "Seconds": ["Seconds", "second", "HMS"],
    "Sidereal Time": ["Sidereal Time"],
    "Skeletonized": ["Skeletonized", "skeleton", "see-through", "transparent", "openwork", "open work"],
    "Sky Chart": ["Sky Chart", "skychart"],
    "Slide Rule": ["Slide Rule"],
    "Small Seconds": ["Small Seconds", "small second"],
    "Split-Seconds": ["Split-Seconds", "Rattrapante"],
    "Stop-Second": ["Stop-Second", "stop seconds"],
    "Sun Position / Rising Time": ["Sun Position / Rising Time", "sun position", "sun rising", "sun rise"],
    "Sweeping Seconds": ["Sweeping Seconds", "sweeping sec"],
    "Tachymeter": ["Tachymeter"],
    "Telemeter": ["Telemeter"],
    "Thermometer": ["Thermometer"],
    "Tide Indication": ["Tide Indication", "tide"],
    "Travel Time": ["Travel Time", "time zone", "time zones", "worldtime", "timezone", "timezones", "GMT"],
    "Tourbillon": ["Tourbillon"],
    "Transparent caseback": ["Transparent caseback"],
    "Triple Calendar": ["Triple Calendar", "complete calendar"],
    "Unidirectional rotating bezel": ["Unidirectional rotating bezel", "uni-directional bezel", "uni-directional rotating"],
    "Week Indicator": ["Week Indicator", "week"],
    "Weekly Calendar": ["Weekly Calendar"],
    "World Time": ["World Time", "worldtime"],
    "Year Indicator": ["Year Indicator", "year"],
    "Zodiac Indications": ["Zodiac Indications", "zodiac"],
}

CRYSTAL = {
    "Sapphire": ["Sapphire", "saphire", "cream"],
    "Plexiglass": ["Plexiglass", "plexi"],
    "Hesalite": ["Hesalite"],
    "Acrylic": ["Acrylic"],
    "Hardlex": ["Hardlex"],
    "Ion-X": ["Ion-X", "ion x", "ionx"],
    "Mineral Glass": ["Mineral Glass", "mineral"],
}

CASE_SHAPE = {
    "Round": ["Round"],
    "Rectangular": ["Rectangular", "rectangle"],
    "Tonneau": ["Tonneau", "barrel"],
    "Cushion": ["Cushion"],
    "Irregular": ["Irregular"],
    "Oval": ["Oval"],
    "Square": ["Square"],
    "Octagon": ["Octagon", "octagonal"],
    "Hexagon": ["Hexagon"],
}

CASEBACK = {
    "Solid": ["Solid", "Closed"],
    "Transparent": ["Transparent", "Open", "Openwork", "Skeleton", "Exhibition"],
    "Hinged": ["Hinged"],
    "Hunter": ["Hunter"],
}

LISTING_TYPE = {
    "Auction": ["place bid", "click here for auction"],
    "Buy it Now": ["buy now", "add to cart"],
    "Contact Seller": ["inquire"],
}

WATCH_TYPE = {
    "Unisex Watches, Men's Watches, Women's Watches": ["men/women", "mens/womens watch", "mens/womens watches", "Men's watch/Unisex", "unisex", "unisex watch", "unisex watches", "Unisex's Watches", "Women's Watches, Men's Watches"],
    "Women's Watches": ["lady", "ladies", "ladys", "women", "Female", "Women's watch"],
    "Men's Watches": ["Mens", "Men", "Mens Watch", "Mens Watches", "Men's", "gent", "gents", "Male"],
    "Pocket Watches": ["pocket watch", "FOB watch", "fob watch", "pocket"],
    "Other / Clock": ["clock", "clocks"],
}
