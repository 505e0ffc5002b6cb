"""Word lists and patterns. All are fixed values."""

BUG = ["bug", "fix", "error", "crash", "null", "broken", "incorrect", "wrong", "fails", "failure", "failing", "exception", "stack trace", "regression", "resolve", "patch", "hotfix"]
REFACTOR = [
    "refactor", "cleanup", "clean up", "restructure", "reorganize", "simplify", "extract", "rename", "move", "rename", "dry", "technical debt", "tech debt", "redundant",
    "consolidate", "split", "merge", "decompose", "composition", "extract function",
]
FEATURE = ["add", "implement", "create", "new", "feature", "support", "introduce", "build", "enable", "endpoint", "route", "handler", "component", "api", "service"]
OPTIMIZE = [
    "optimize", "performance", "perf", "faster", "slow", "speed", "memory", "reduce", "lazy", "cache", "memoize", "throughput", "bottleneck", "profile", "transducer", "reduce",
]
TEST = ["test", "spec", "assert", "coverage", "expect", "generative", "property-based", "check"]
DOCS = ["doc", "readme", "comment", "docstring", "documentation"]
#: Classes in order of precedence.
CHANGE_TYPES = [("bug-fix", BUG), ("refactor", REFACTOR), ("add-feature", FEATURE), ("optimize", OPTIMIZE), ("test", TEST), ("docs", DOCS)]

CODE_TERMS = [
    "defn", "defmacro", "defprotocol", "defmulti", "defmethod", "defrecord", "deftype", "ns", "require", "use", "import", "let", "fn", "loop", "recur", "doseq", "for", "when-let",
    "if-let", "cond->", "->", "->>", "comp", "partial", "memoize", "atom", "swap!", "reset!", "ref", "alter", "dosync", "future", "promise", "deliver", "channel", "go", "<!",
    "core.async", "transducer", "reducer", "lazy-seq", "ring", "compojure", "reitit", "pedestal", "http-kit", "reagent", "re-frame", "rum", "helix", "datomic", "xtdb", "next.jdbc",
    "hugsql", "spec", "test.check", "clojure.test", "component", "integrant", "mount", "mycelium",
]
TASK_WORDS = [
    "refactor", "fix", "add", "implement", "change", "update", "create", "remove", "replace", "convert", "migrate", "optimize", "should", "need to", "want to", "please",
]

NON_CODE_FILES = ["project.clj", "build.boot", "deps.edn", "build.clj", ".github/", "Jenkinsfile", "Dockerfile", "Makefile"]
NON_CODE_PREFIXES = ["resources/", "doc/", "docs/", "test-resources/", "dev-resources/"]
CODE_EXTENSIONS = [".clj", ".cljs", ".cljc", ".edn"]
SOURCE_EXTENSIONS = [".clj", ".cljs", ".cljc"]
TRIVIAL_MESSAGE = r"(?i)^\s*(merge\b|revert\b|bump\b|release\b|v?\d+\.\d+|version\b|changelog|readme|typo|cljfmt|lint\b|format\b|whitespace|wip\b|fixup\b|squash\b|\.gitignore)"
COMMIT_PREFIXES = ["wip", "fix", "feat", "refactor", "chore", "docs", "test", "perf", "style", "build", "ci", "revert"]

CONCURRENCY_FORMS = [
    "atom", "swap!", "reset!", "deref", "@/", "@", "ref", "dosync", "alter", "commute", "ensure", "agent", "send", "send-off", "send-via", "agent-error", "future", "promise",
    "deliver", "add-watch", "remove-watch",
]
SIDE_EFFECT_FORMS = [
    "spit", "slurp", "println", "printf", "pr", "prn", "io!", "with-open", "delete-file", "jdbc/insert!", "jdbc/update!", "jdbc/delete!", "clj-http/client", "http/post",
    "http/get", ".write", ".close", ".flush",
]
ASYNC_FORMS = [
    "go", "go-loop", "<!", ">!", "<!!", ">!!", "chan", "close!", "alts!", "alts!!", "onto-chan!", "thread", "put!", "take!", "pipe", "mult", "tap", "pub", "sub", "mix",
]
SPEC_FORMS = ["s/def", "s/fdef", "s/valid?", "s/conform", "s/cat", "s/alt", "s/keys", "s/merge", "s/every", "s/coll-of"]
MULTIMETHOD_FORMS = ["defmulti", "defmethod"]
PROTOCOL_FORMS = ["defprotocol", "defrecord", "deftype", "extend-protocol", "extend-type", "reify", "satisfies?", "extends?"]
MACRO_FORMS = ["defmacro", "`", "~", "~@", "gensym", "macroexpand"]
STRUCTURE_FORMS = ["->", "->>", "comp", "partial", "update", "assoc", "dissoc", "get-in", "map", "filter", "reduce", "mapcat"]
DATA_EXTENSIONS = [".edn", ".xml", ".properties", ".json"]
EFFECT_FILES = ["effects", "io", "db", "http", "api", "gateway"]
CORE_FILES = ["core", "handler", "service", "logic"]
DEFINITION_FORMS = [
    "def ", "def\n", "defn ", "defn\n", "defn-", "defmacro", "defmulti", "defmethod", "defrecord", "deftype", "defprotocol", "defonce", "require", "ns ", "ns\n", "import", "use ",
    "in-ns", "refer",
]

MOVES = [
    ("Metaphor", "contains", ["like", "as if", "resembles", "similar to", "as though"]),
    ("Personal Observation", "starts", ["i ", "we ", "one ", "i'm ", "we're "]),
    ("Technical Definition", "contains", ["defined as", "refers to", "means that", "is called"]),
    ("Rhetorical Question", "contains", ["?"]),
    ("Contrast", "first three", ["however", "but", "yet", "although", "while"]),
    ("Consequence", "contains", ["because", "therefore", "thus", "hence", "consequently"]),
]
CONNECTIVES = ["however", "although", "yet", "moreover", "furthermore", "nevertheless", "whilst", "whereas"]
COMPLEX_MARKS = [";", "—", "--", ":", "(", ")"]

COMMON_WORDS = (
    "the and of to a in is that for it was with as be on not this but by from or have an they which one you were her all she there would their we him been has when who will more "
    "if no out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also "
    "did many before must through back years where much your way well down should because each just those people how too little state good very make world still own see men work long "
    "get here between both life being under never day same another know while last might us great old year"
).split()
#: Content words of 5 letters or more leave these out before clustering.
CLUSTER_STOP_WORDS = (
    "that this with from have were been would could should their there which about into more some only other such than then when what where very just even most also over they them "
    "these those will might must shall being having doing made said came went told knew thought seemed found gave took like upon before after through between under above below "
    "without within around against along across behind beyond during until while never always often still already ever again back down away here now well much many each every both "
    "itself himself myself themselves"
).split()
RICHNESS_STOP_WORDS = (
    "the and that have for not with you this but his from they were been their would there which could other into more about through between because something everything anything "
    "nothing however although therefore whatever"
).split()
CLAUSE_MARKERS = "which whom whose where when while although though because since unless until whereas whereby wherein whereupon".split()
FIRST_SINGULAR = "i me my mine myself".split()
FIRST_PLURAL = "we us our ours ourselves".split()
THIRD = "he she it they him her them his hers its their".split()
DARK_WORDS = (
    "eldritch cyclopean non-euclidean blasphemous nameless unnameable gibbous squamous rugose foetid antediluvian charnel daemon daemonic accursed hellish loathsome hideous abhorrent "
    "grotesque monstrous abysmal stygian phantasmal spectral preternatural abnormal unnatural indescribable unutterable ineffable cosmic immemorial aeons eons primordial prehistoric "
    "archaic ancient forgotten forbidden dreaded feared terrible horror terror dread fear madness insanity nightmare betwixt whilst amidst amongst wherefore hitherto thence hence "
    "thereof wherein whereby"
).split()
DARK_PATTERNS = [
    r"beyond the .{1,20} of", r"in the .{1,20} depths", r"from .{1,20} aeons", r"the .{1,20} horror", r"nameless .{1,20}", r"unutterable .{1,20}", r"cosmic .{1,20}",
]

TRANSITIONS = {
    "additive": ["and", "moreover", "furthermore", "also", "besides", "additionally", "plus"],
    "adversative": ["but", "yet", "however", "nevertheless", "nonetheless", "still", "though", "although"],
    "causal": ["thus", "therefore", "hence", "consequently", "wherefore", "so", "accordingly"],
    "temporal": ["then", "whereupon", "thereafter", "meanwhile", "subsequently", "afterward", "next"],
    "exemplifying": ["indeed", "specifically", "namely", "particularly", "especially"],
}
MACHINE_TRANSITIONS = ["furthermore", "additionally", "moreover", "in addition", "it is important"]
CERTAINTY = ["clearly", "obviously", "undeniably", "surely", "certainly", "undoubtedly", "plainly"]
HEDGES = ["perhaps", "possibly", "maybe", "seemingly", "apparently", "arguably", "conceivably"]
ADDRESS = ["you", "your", "we", "our", "one"]
ARCHAIC = (
    "whereupon whilst heretofore hitherto thereof wherein thereby forthwith henceforth thence whence whereof notwithstanding erstwhile forsooth verily betwixt"
).split()
EMOTIONS = "dread horror terror fear awe wonder fascination revulsion loathing despair anguish melancholy rapture ecstasy triumph fury rage passion yearning longing".split()
SENSORY = "rough smooth sharp dull bright dim shimmering gleaming luminous phosphorescent viscous pulsating crepuscular iridescent opalescent fetid putrid writhing".split()

TEMPORAL_WORDS = "then after before when while during later earlier soon finally eventually suddenly once".split()
SEQUENCE_WORDS = "first second third next finally began started ended".split()
CONCEPT_WORDS = (
    "concept theory mechanism process system principle function method approach technique structure pattern relationship connection effect cause result factor element component aspect "
    "nature essence phenomenon"
).split()
DEFINITION_PHRASES = ["is defined as", "refers to", "means that", "is called", "can be described as", "is characterized by", "consists of"]
IMPERSONAL_OPENINGS = ["it is", "there are", "there is", "this is", "these are"]
TITLE_SMALL_WORDS = "a an the and or but in on at to for of with by is are was were".split()
#: Stand-ins for a tagger's stop words, where content words are told by a list.
STOP_WORDS = sorted({*COMMON_WORDS, *"he his i at are had it's am does done has having while upon were being".split()})
ENTITY_SUFFIXES = ["ists", "isms", "ians", "ist", "ism", "ian", "ean", "ic", "an", "s"]
