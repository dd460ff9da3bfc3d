"""The word lists and patterns that results depend on. Nothing here is logic."""

#: One whitespace character, as a regex class that Java, RE2 and Python read alike (Unicode blanks and line breaks).
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: Diagram classes, first match wins; alternatives of one word-bounded, case-blind group.
CLASSES = [
    ("flowchart", r"flow|flowchart|method|flow\s*diagram|step|process|operation|block\s*(?:[0-9]+)?"),
    ("block diagram", r"block\s*diagram|module|unit|processor|controller|bus|interface|cpu|gpu|memory"),
    ("mechanical", r"shaft|gear|housing|valve|bracket|piston|bearing|assembly|fastener|linkage|spring"),
    ("electrical schematic", r"resistor|capacitor|inductor|transistor|op[- ]?amp|schematic|circuit"),
    ("graph", r"graph|plot|chart|curve|vs\.|x[- ]?axis|y[- ]?axis"),
    ("perspective", r"perspective|isometric|3d|exploded"),
    ("orthographic", r"front\s*view|side\s*view|top\s*view|section|cross[- ]?section|plan\s*view"),
]
OTHER_CLASS = "line art"

VIEWS = r"perspective|isometric|front\s*view|side\s*view|top\s*view|rear\s*view|section|cross[- ]?section|plan\s*view"
UNKNOWN = "unspecified"
NO_LABELS = "if present"

#: A figure reference: FIG, FIG. or FIGURE, then up to three digits and a letter.
FIGURE = r"\bFIG(?:\.|URE)?\s*\.?[-\s]*([0-9]{1,3}[A-Za-z]?)\b"

DASHES = "–—―−‐‑‒﹘﹣－"
LABEL_TRIM = "\"'()[]{}.,;!?`~:"

#: Keywords: words left out, and beginnings of words left out.
KEYWORD_STOPS = """the a an of and or to in on for from with without into onto is are be as by at over under between within this that those
these system device method apparatus component unit module figure fig diagram view example exemplary may can one two three first second
third accordance embodiment present disclosure invention figs etc such including shown includes used using also use different various variety
conceptual illustrating more techniques scenario which where when according combining aspect comprising""".split()
KEYWORD_STARTS = """compris includ hav contain form generat provid configur adapt operat connect coupl mount attach support communicat interfac
transmit receiv process calculat determin select control regulat modulat adjust align position orient rotat mov extend retract insert engag
disengag activat deactivat illustrat depict correspond represent show plurality number various several multiple different diverse assorted
distinct varied variegated utiliz employ implement execut perform oper function""".split()

#: Relations in order: canonical label, its stem, its pattern (case-blind).
RELATIONS = [
    ("connected to", "connect", r"\bconnect(?:ed|s|ing)?\s+(?:to|with)\b"),
    ("connected with", "connect", r"\bconnect(?:ed|s|ing)?\s+(?:with)\b"),
    ("coupled to", "coupl", r"\bcoupl(?:ed|es|ing)?\s+(?:to|with)\b"),
    ("coupled with", "coupl", r"\bcoupl(?:ed|es|ing)?\s+(?:with)\b"),
    ("attached to", "attach", r"\battach(?:ed|es|ing)?\s+(?:to|with|on)\b"),
    ("mounted to", "mount", r"\bmount(?:ed|s|ing)?\s+(?:to|on|over|above)\b"),
    ("joined to", "join", r"\bjoin(?:ed|s|ing)?\s+(?:to|with)\b"),
    ("linked to", "link", r"\blink(?:ed|s|ing)?\s+(?:to|with)\b"),
    ("engaged with", "engag", r"\bengag(?:ed|es|ing)?\s+(?:with|to)\b"),
    ("supported by", "support", r"\bsupport(?:ed|s|ing)?\s+(?:by|on|upon)\b"),
    ("communicates with", "communicat", r"\bcommunicat(?:es|ed|ing)?\s+(?:with|to)\b"),
    ("in communication with", "communication", r"\bin\s+communication\s+(?:with|to)\b"),
    ("in fluid communication with", "communication", r"\bin\s+fluid\s+communication\s+(?:with|to)\b"),
    ("fluidly connected to", "connect", r"\bfluid(?:ly)?\s+connect(?:ed|s|ing)?\s+(?:to|with)\b"),
    ("electrically connected to", "connect", r"\belectrical(?:ly)?\s+connect(?:ed|s|ing)?\s+(?:to|with)\b"),
    ("in electrical communication with", "communication", r"\bin\s+electrical\s+communication\s+(?:with|to)\b"),
    ("interfaces with", "interface", r"\binterface(?:s|d|ing)?\s+(?:with|to)\b"),
    ("between", "between", r"\bbetween\b"),
    ("extends between", "extend", r"\bextend(?:s|ed|ing)?\s+(?:between)\b"),
    ("within", "within", r"\bwithin\b"),
    ("inside", "inside", r"\binside\b"),
    ("outside", "outside", r"\boutside\b"),
    ("adjacent to", "adjacent", r"\badjacent\s+(?:to|with)\b"),
    ("above", "above", r"\babove\b"),
    ("below", "below", r"\bbelow\b"),
    ("disposed on", "dispos", r"\bdispos(?:ed|es|ing)?\s+(?:on|over|upon)\b"),
    ("disposed in", "dispos", r"\bdispos(?:ed|es|ing)?\s+(?:in|within|inside)\b"),
    ("disposed between", "dispos", r"\bdispos(?:ed|es|ing)?\s+(?:between)\b"),
    ("disposed adjacent to", "dispos", r"\bdispos(?:ed|es|ing)?\s+(?:adjacent\s+(?:to|with))\b"),
    ("positioned on", "position", r"\bposition(?:ed|s|ing)?\s+(?:on|over|upon)\b"),
    ("positioned in", "position", r"\bposition(?:ed|s|ing)?\s+(?:in|within|inside)\b"),
    ("positioned between", "position", r"\bposition(?:ed|s|ing)?\s+(?:between)\b"),
    ("located on", "locat", r"\blocat(?:ed|es|ing)?\s+(?:on|over|upon)\b"),
    ("located in", "locat", r"\blocat(?:ed|es|ing)?\s+(?:in|within|inside)\b"),
    ("located near", "locat", r"\blocat(?:ed|es|ing)?\s+(?:near)\b"),
    ("extends from", "extend", r"\bextend(?:s|ed|ing)?\s+(?:from)\b"),
    ("extends to", "extend", r"\bextend(?:s|ed|ing)?\s+(?:to)\b"),
    ("extends over", "extend", r"\bextend(?:s|ed|ing)?\s+(?:over)\b"),
    ("extends about", "extend", r"\bextend(?:s|ed|ing)?\s+(?:about)\b"),
    ("extends through", "extend", r"\bextend(?:s|ed|ing)?\s+(?:through)\b"),
    ("secured to", "secur", r"\bsecur(?:ed|es|ing)?\s+(?:to)\b"),
    ("defined by", "defin", r"\bdefin(?:ed|es|ing)?\s+(?:by)\b"),
]

#: Bare phrases, looked for when no relation has a side.
RELATION_PHRASES = [
    "connected to", "connected with", "coupled to", "coupled with", "attached to", "mounted to", "joined to", "linked to", "engaged with", "supported by",
    "supported on", "in communication with", "communicates with", "fluidly connected to", "in fluid communication with", "electrically connected to",
    "in electrical communication with", "interfaces with", "between", "extends between", "within", "inside", "outside", "adjacent to", "above", "below",
    "disposed on", "disposed in", "disposed over", "disposed between", "disposed adjacent to", "positioned in", "positioned on", "positioned over",
    "positioned inside", "positioned between", "located in", "located on", "located near", "extends from", "extends to", "extends over", "extends about",
    "extends through", "secured to", "operably coupled to",
]

RELATION_STOPS = set("the a an and or of to with in on at by for is are was were be been being that this these those".split())
RELATION_BOUNDS = set("""connect connected connection connections connecting couple coupled couples coupling attach attached attaches attaching
mount mounted mounting mounts join joined joining joins link linked links linking engage engaged engages engaging support supported supports
supporting communicate communicates communicated communicating communication interface interfaces interfacing interfaced extend extends extended
extending fluidly electrically between within inside outside adjacent above below disposed disposes disposing positioned positions positioning
located locates locating secured secures securing defined defines defining""".split())
LEADING_FILLERS = set("""a an the this that these those said such another its their fig figs figure to with of for in on at one first second third
other portion part member element component device system assembly""".split())
TRAILING_FILLERS = set("and or of to with for in on at respectively portion part member element component device system assembly".split())
AUXILIARIES = set("is are was were be been being may can will shall would could should might must".split())
CLAUSE_BREAKS = set("""wherein where which while when because since however thereby thereof therein thereon therefrom therewith thereafter thereto
whereby whereof whereon illustrate illustrates illustrated illustrating depict depicts depicted depicting show shows showed showing display displays
displayed displaying present presents presented presenting describe describes described describing via through""".split())
HARD_PUNCTUATION = ".;:?!\n()[]"

LABEL_SKIPS = set("""a an the said mentioned aforementioned is are was were be been being may can will shall would could should this that these
those another such its their of in on at by for with within between to from into onto fig figs figure""".split())
LABEL_BREAKS = set("""illustrate illustrates illustrated illustrating describe describes described describing depict depicts depicted depicting show
shows showed showing include includes included including comprise comprises comprised comprising communicate communicates communicated communicating
provide provides provided providing represent represents represented representing present presents presented presenting define defines defined
defining""".split())
ORDINALS = ("st", "nd", "rd", "th")

#: English stop words of the text index.
INDEX_STOPS = """a about above after again all am an and any are as at be because been before being below between both but by can did do does doing
down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not
now of off on once only or other our out over own same she should so some such than that the their them then there these they this those through to
too under until up very was we were what when where which while who whom why will with you your""".split()
