"""Problem 4: template residue, filler, error pages and script notices in place of content.

Each value is normalised: case and Unicode form, site names and ornaments at its ends, and numbers, addresses and dates
masked. The exact hashes of the normal forms of all values are grouped over all hosts with map-side pre-aggregation. A
value is residue if it holds an unfilled placeholder, if its whole is one of the message forms below, or if its form recurs
on several hosts, is spelled by no address, as headlines are, and is worded like a notice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.runtime import computed, cut_lineage

# Variables of page templates, as the names in a placeholder are built.
_NAME = "[\\p{L}_][\\p{L}\\p{N}_.-]*"
_PLACEHOLDERS = [
    "\\{\\{[^{}]*\\}\\}",  # {{ name }}
    "\\{%[^%]*%\\}",  # {% block %}
    "<%[=-]?[^%]*%>",  # <%= name %>
    "\\[%[^%]*%\\]",  # [% name %]
    "\\$\\{" + _NAME + "\\}",  # ${name}
    "[#%]\\{" + _NAME + "\\}",  # #{name} %{name}
    "@@" + _NAME + "@@",
    "%%" + _NAME + "%%",
    "__[A-Z\\u00c4\\u00d6\\u00dc][A-Z\\u00c4\\u00d6\\u00dc_]*__",
    "%[A-Z\\u00c4\\u00d6\\u00dc][A-Z\\u00c4\\u00d6\\u00dc_]{2,}%",
    "\\[\\[" + _NAME + "\\]\\]",
    "\\[[A-Z\\u00c4\\u00d6\\u00dc][A-Z\\u00c4\\u00d6\\u00dc_]{3,}\\]",
    "<[A-Z\\u00c4\\u00d6\\u00dc_]{3,}(?: HERE)?>",
    "\\{[0-9]{1,2}\\}",  # {0}
    "(?<![\\p{L}\\p{N}])%[0-9]?\\$?[sd](?![\\p{L}\\p{N}])",
    "\\[object Object\\]",
    "\\$[A-Z]{3,}_[A-Z_]+\\$?",
    "(?<![\\p{L}\\p{N}])(?:undefined|NaN)(?![\\p{L}\\p{N}-])",
    "#(?:REF|NAME|VALUE|N/A)[!?]?(?![\\p{L}])",
]
PLACEHOLDER = "|".join(_PLACEHOLDERS)

# The wording of messages that stand in place of content, matched against the whole normal form. "#" is any
# masked number, ".*" stays within the message.
_STATUS = "(?:not found|forbidden|gone|bad gateway|bad request|unauthorized|gateway time-?out|internal server error|service (?:temporarily )?unavailable|rate limit exceeded|too many requests|moved permanently|request timeout|method not allowed|nicht gefunden|zugriff verweigert|nicht verfügbar)"
#: What may follow a message: signs, a remark in brackets or behind a dash, another sentence, but no headline after a colon.
_TAIL = "(?:[^\\p{L}\\p{N}]*|,? ?[-(/|#,].*|[.!] .*)"
MESSAGES = [
    # scripts
    "(?:please |bitte |veuillez |por favor,? |per favore,? )?(?:enable|activate|turn on|allow|aktivier\\w*|einschalten|schalten sie|activez|activer|activa|active|active el|habilita|habilite|abilita|abilitare|attiva|attivare|schakel|zet) (?:sie |you must |eerst )?(?:java ?script|scripts?|skripte).*",
    "(?:you need to|you must|you have to) (?:enable|allow) (?:java ?script|scripts?).*",
    "java ?script (?:is|ist|est|n'est|está|è|staat) (?:not|nicht|pas|no|non|disabled|deaktiviert|désactivé|desactivado|disattivato|required|erforderlich|requis|uit).*",
    "ohne (?:java ?script|skripte) (?:läuft|geht|funktioniert).*(?:hier|seite|nicht|nichts).*",
    "(?:diese|die) (?:seite|website|anwendung) (?:benötigt|braucht|erfordert) .*(?:java ?script|skripte).*",
    "(?:this|the) (?:page|site|website|app|application) (?:requires|needs) .*(?:java ?script|scripts?).*",
    "your browser (?:has|does not|doesn't|is) .*(?:script\\w*|supported|unsupported|outdated).*",
    "(?:ihr|dein) browser .*(?:java ?script|skripte|veraltet|nicht unterstützt).*",
    "we've detected that java ?script is disabled.*",
    # errors
    "(?:error|fehler|erreur|errore|fout|status|http|http error|http status)? ?[:#/|-]* ?#+ ?[:#/|(-]* ?" + _STATUS + "\\)?(?: ?[/|(-].*)?",
    "(?:error|fehler|erreur|errore|fout|status|http)[ :#/-]*#\\W*(?:gone|" + _STATUS + ").*",
    "#? ?[-|:]* ?(?:bad gateway|gateway timeout|internal server error|service (?:temporarily )?unavailable)(?: \\(.*\\))?",
    "# ?[-:|]? ?(?:seite|page|página|pagina) (?:nicht gefunden|not found|no encontrada|introuvable|non trovata|niet gevonden)" + _TAIL + "",
    "(?:die |the |la |esta )?(?:angeforderte |requested )?(?:seite|page|página|pagina|artikel|article) (?:wurde |is |ist |est |was |could |konnte |ya )?(?:nicht gefunden|not found|not be found|nicht gefunden werden|introuvable|no existe|no encontrada|non trovata|niet gevonden|existiert (?:leider )?nicht(?: mehr)?|n'existe (?:plus|pas)|non (?:esiste|è disponibile))" + _TAIL + "",
    "(?:oops|ups|hoppla|sorry|whoops)\\W+ ?(?:.*(?:can't|cannot|can not|couldn't) (?:find|load).*|.*(?:schiefgelaufen|schief gegangen|schiefgegangen).*|.*went wrong.*|.*not found.*|.*nicht gefunden.*)",
    "(?:da ist )?etwas (?:ist )?schief ?gelaufen.*|something went wrong.*|une erreur (?:est survenue|s'est produite).*|ha ocurrido un error.*|si è verificato un errore.*|er is iets (?:mis|fout) ?gegaan.*",
    "(?:this |the )?(?:site|page|website|webpage) (?:can't|cannot|can not|could not|couldn't) be (?:reached|found|displayed|loaded).*",
    "(?:access|permission) denied(?:[.! ]+(?:reference|you|error|code|id|on this|to this|for|please|contact)\\b.*|[^\\p{L}]*| ?\\(.*\\))|zugriff (?:verweigert|nicht gestattet)(?:[^\\p{L}:]*| ?\\(.*\\)|\\. .*)|(?:accès (?:refusé|interdit)|acceso denegado|accesso negato|toegang geweigerd)(?:[^\\p{L}:]*| ?\\(.*\\)|\\. .*)",
    "(?:# ?)?forbidden.*(?:permission|access).*|you (?:don't|do not) have permission.*",
    "(?:too many requests|rate limit exceeded|zu viele anfragen)" + _TAIL + "",
    "(?:fatal |parse |syntax )error: .*(?:exception|on line|unexpected|uncaught).*|warning: .* on line #.*|uncaught (?:exception|error|typeerror).*|traceback \\(most recent call last\\).*",
    "error establishing a database connection.*|database (?:connection )?error.*|datenbankfehler.*|could not connect to (?:the )?database.*",
    "just a moment.*|checking your (?:browser|connection).*|attention required.*|are you (?:a )?(?:human|robot).*|verify (?:that )?you are (?:a )?human.*|please complete the captcha.*",
    "(?:ihre |die |deine )?(?:sitzung|session) (?:ist )?abgelaufen.*|(?:your )?session (?:has )?(?:expired|timed out).*|(?:votre |la )?session (?:a )?expirée?.*|(?:la |su )?sesión (?:ha )?(?:caducado|expirado).*|sessione scaduta.*|(?:uw |de )?sessie (?:is )?verlopen.*",
    "(?:document (?:not found|moved))" + _TAIL + "",
    # maintenance
    "wartungsarbeiten(?:\\W.*(?:gleich|bald|wieder|zurück|verfügbar).*)?|wegen wartung.*|.*(?:site|page|website|seite) is (?:currently )?(?:down for|under|undergoing) (?:scheduled )?(?:maintenance|construction).*|(?:scheduled |site )?maintenance(?: mode| in progress|\\W+we.*)?|we(?:'ll| will) be (?:right )?back (?:soon|shortly).*|(?:site )?en maintenance.*|(?:sitio )?en mantenimiento.*|(?:sito )?in manutenzione.*|coming soon|under construction|hier entsteht .*(?:seite|website|webseite|internetpräsenz).*",
    "(?:der |the )?(?:service|server|dienst) (?:is |ist )?(?:temporarily |vorübergehend )?(?:unavailable|nicht (?:verfügbar|erreichbar)|overloaded|überlastet).*",
    # filler
    "(?:.{0,20}\\W)?lorem ipsum dolor.*|(?:ipsum )?dolor sit amet.*|.*consetetur sadipscing.*|.*consectetur adipisc.*|lorem ipsum",
    "(?:dies(?:er text)? |das |hier )?(?:ist |steht )?(?:ein |nur )?(?:blindtext|platzhalter(?:text)?|fülltext|mustertext|beispieltext|dummytext)(?:[.!(].*)?",
    "platzhalter \\p{L}+(?: \\(.*\\))?|placeholder(?: (?:text|title|headline|image))?(?: \\(.*\\))?",
    "(?:your|ihre?|votre|deine?|tu|su|il tuo|uw|jouw) (?:headline|title|text|description|subtitle|titel|überschrift|beschreibung|texte|titre|título|texto|titolo|testo|tekst|tagline|site title) (?:goes here|here|hier|ici|aquí|qui)(?:\\W.*)?",
    "(?:insert|add|enter|write|type) (?:your |a |the |an )?(?:meta |site |page |short )?(?:description|title|headline|subtitle|text|tagline|content|caption|keywords|name)(?: here| in the settings.*|\\W.*)?",
    "(?:todo|fixme|tbd|xxx)\\b[: ].*|to ?do|tbd|fixme",
    "hier (?:steht|stehen|kommt|folgt|könnte) (?:später |bald |noch |dann )?(?:die|der|das|ihre?|ein) (?:beschreibung|text|titel|überschrift|inhalt|teaser|werbung)\\b.*",
    "just another .*(?:site|blog|tagline|weblog).*|sample page|hello world!?|my blog",
    "(?:neue seite|new page|nouvelle page|nueva página|nuova pagina|nieuwe pagina|untitled|unbenannt(?:es dokument)?|sans titre|sin título|senza titolo|naamloos|untitled document|no title|kein titel|ohne titel|home ?page|document)(?: #)?(?: \\(.*\\))?",
    "(?:x{3,}\\W*)+|(?:asdf|qwert[yz]?|jklö|jkl;|foo|bar|baz|blah?|test|dummy|bla|asd)(?:\\W+(?:asdf|qwert[yz]?|jklö|jkl;?|foo|bar|baz|blah?|test|dummy|bla|asd|#|bitte löschen|please delete|123))+|(?:test\\W*){2,}.*(?:löschen|delete|ignore|ignorieren).*|test",
    "(?:null|none|undefined|nan|n/a|false|true|\\(null\\)|nil)",
    ".*texte? (?:à|a) (?:remplacer|reemplazar|sostituire).*|.*(?:replace|ersetzen|replaced|te vervangen) (?:this|diesen|me|text|dieser).*(?:text|line)?",
]
MESSAGE = "^(?:" + "|".join(MESSAGES) + ")$"

# Words of the messages, for messages that are not listed but recur everywhere.
FILLER_WORDS = (
    "(?<![\\p{L}])(?:lorem|ipsum|dolor|sit|amet|consetetur|consectetur|sadipscing|adipiscing|adipisicing|elit|elitr|sed|diam|nonumy|eirmod|tempor|invidunt|ut|labore|et|dolore|magna|aliquyam|aliqua|erat|voluptua|at|"
    "vero|eos|accusam|justo|duo|dolores|ea|rebum|stet|clita|kasd|gubergren|no|sea|takimata|sanctus|est|eiusmod|incididunt|enim|minim|veniam|quis|nostrud|exercitation|ullamco|laboris|nisi|aliquip|ex|commodo|consequat|"
    "duis|aute|irure|in|reprehenderit|voluptate|velit|esse|cillum|eu|fugiat|nulla|pariatur|excepteur|sint|occaecat|cupidatat|non|proident|sunt|culpa|qui|officia|deserunt|mollit|anim|id|laborum)(?![\\p{L}])"
)

# Word classes of notices, for messages that no form lists. A form that recurs on many hosts is a notice if it
# says that something fails (_FAILS) or speaks of the means (_MEANS), and also holds a word of another class.
_FAILS = (
    "\\b(?:not available|no longer|unavailable|not (?:be )?found|does ?n[o']t exist|nicht (?:mehr )?(?:verfügbar|gefunden|erreichbar|vorhanden|möglich|erlaubt|geladen)|existiert nicht|removed|deleted|expired|denied|forbidden|blocked|restricted|failed|gelöscht|entfernt|abgelaufen|"
    "verweigert|gesperrt|fehlgeschlagen|error|fehler|erreur|errore|fout|erro|introuvable|indisponible|n'existe|supprimée?|expirée?|refusée?|bloquée?|no (?:está |se encuentra )?disponible|(?:no|não) encontrad[oa]|no existe|eliminad[oa]|caducad[oa]|denegad[oa]|"
    "não (?:está )?disponível|non (?:è )?(?:più )?disponibile|non trovat[oa]|non esiste|rimoss[oa]|scadut[oa]|negat[oa]|niet (?:meer )?(?:beschikbaar|gevonden|bereikbaar)|bestaat niet|verwijderd|verlopen|geweigerd|geblokkeerd|try again|erneut versuchen|réessayer|riprova|opnieuw)\\b"
)
_MEANS = (
    "\\b(?:java ?script|scripts?|browser|navigateur|navegador|cookies?|captcha|log ?in|sign ?in|logged in|register|subscribe|anmelden|einloggen|registrieren|abonnieren|connecter|connectez|connexion|inscrire|iniciar sesión|inicia sesión|acceda|regístrese|accedere|accedi|registrati|inloggen|aanmelden|"
    "redirect(?:ed|ing)?|weitergeleitet|redirigée?|loading|wird geladen|chargement|cargando|caricamento|session|sitzung|timeout|gateway|server|datenbank|database|maintenance|wartung|robot|verify|access|zugriff|accès|acceso|accesso|toegang|permission|enable|disabled?|aktivieren|activer|activar|attivare)\\b"
)
_PLACE = (
    "\\b(?:page|site|website|webseite|seite|angebot|offer|inhalte?|content|artikel|article|story|video|vidéo|document|dokument|link|url|account|konto|compte|cuenta|página|pagina|sitio|sito|contenido|contenu|contenuto|inhoud|artículo|articolo|land|country|region|pays|país|paese)\\b"
)
_THIS = "\\b(?:this|that's|diese[mnrs]?|hier|here|cette|cet|ici|este|esta|aquí|quest[oa]|qui|deze|dit|deze)\\b"
_READER = "\\b(?:you|your|please|sie|ihr(?:e[mnrs]?)?|bitte|vous|votre|veuillez|usted|su|por favor|per favore|tuo|tua|uw|alstublieft|must|müssen|devez|debe|devi|moet)\\b"
#: What reports about a notice, so that it is a headline.
_REPORTS = "^(?:kommentar|bericht|report|comment|opinion|analyse|interview|umfrage|urteil|streit): |,? (?:sagt|sagen|meint|warnt|laut|says|said|warns|dit|dice|zegt|according to|selon|según|secondo|volgens) "
#: Hosts on which a form must stand to recur widely, and slug words from which an address can be compared with a value.
LEAST_SOURCES, LEAST_SLUG = 3, 3

_FORM = "\\p{Z}\\s"


# Each placeholder form begins with one of these, so values without are passed over.
_MARKS = "[{<%@#\\[_$]|undefined|NaN"
_ADDRESS = "(?:https?://|www\\.)[^ ]+|[^ @]+@[^ @]+\\.[a-z]+|[^ ]+\\.(?:example|test|invalid|com|org|net|de)(?:/[^ ]*)?"
# What every address holds; the search for addresses itself is slow on long words.
_ADDRESSED = "://|www\\.|@|\\.(?:example|test|invalid|com|org|net|de)"
_SITE = " (?:\\||//|-|·|») [^|]{2,40}$"


def _spelled(value: Column) -> Column:
    v = F.regexp_replace(value, "[\\u00ad\\u200b-\\u200f\\u2060\\ufeff]", "")
    v = F.regexp_replace(F.lower(v), "[" + _FORM + "]+", " ")
    return F.translate(v, "’‘“”–—…", "''\"\"--.")


def _masked(v: Column) -> Column:
    v = F.when(v.rlike(_ADDRESSED), F.regexp_replace(v, _ADDRESS, "@")).otherwise(v)
    v = F.regexp_replace(v, " ?[(\\[](?:id|ref|code|nr|no|ray)?[.:#]? ?[0-9][0-9a-f-]*[)\\]]$", "")
    v = F.regexp_replace(v, "[0-9]+(?:[.,:/-][0-9]+)*", "#")
    v = F.regexp_replace(v, "^(?:[" + _FORM + "!+*>»·\\u2022=~-]|\\[#\\]|(?:notice|hinweis|warning|warnung|achtung|info|attention|avviso|aviso|let op|meldung)(?:: ))+", "")
    v = F.regexp_replace(v, "[" + _FORM + "!+*<>«».·\\u2022=~-]+$", "")
    return F.trim(v)


def normal_form(value: Column, site: bool = True) -> Column:
    """Lower case without ornaments and reference numbers at the ends, and with ``site`` without the name of the site
    behind a separator; numbers, addresses and dates masked."""
    v = _spelled(value)
    return _masked(F.regexp_replace(v, _SITE, "") if site else v)


def site_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^(?:[a-zA-Z]+:)?//([^/?#]+)", 1))


def _latin(value: Column) -> Column:
    """Lower case with the spelling of addresses: umlauts as two letters, other letters without accents."""
    v = F.translate(F.lower(value), "áàâãåéèêëíìîïóòôõúùûñçýÿ", "aaaaaeeeeiiiioooouuuncyy")
    for letter, two in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        v = F.replace(v, F.lit(letter), F.lit(two))
    return v


def tied_to(value: Column, page: Column) -> Column:
    """Whether the address of ``page`` spells the value: at least half of its words, if it has LEAST_SLUG; never null."""
    path = F.regexp_replace(F.lower(page), "^(?:[a-z]+:)?//[^/?#]*|[?#].*$|\\.[a-z]+$", "")
    slug = F.array_distinct(F.regexp_extract_all(path, F.lit("([a-z]{3,})"), F.lit(1)))
    spelled = lambda ws: F.size(F.array_intersect(ws, F.split(_latin(value), "[^a-z]+"))) * 2 >= F.size(ws)
    return F.coalesce(F.exists(F.array(slug), lambda ws: (F.size(ws) >= LEAST_SLUG) & spelled(ws)), F.lit(False))


def is_notice(form: Column) -> Column:
    """A form that says what fails or with which means, also speaks of a place, of the reader or of both kinds, and reports
    of nobody."""
    one = lambda pattern: form.rlike(pattern).cast("int")
    return form.rlike(_FAILS + "|" + _MEANS) & (one(_FAILS) + one(_MEANS) + one(_PLACE) + one(_THIS) + one(_READER) >= 2) & ~form.rlike(_REPORTS)


def values_of(table: DataFrame, name: str, key: str, fields: list[str], page: Column) -> DataFrame:
    """(table_name, record_id, field_name, value, page) of all non-null values of ``fields``; page is the address."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields]))
    return table.select(F.lit(name).alias("table_name"), F.col(key).alias("record_id"), page.alias("page"), pairs.alias("v")).select("table_name", "record_id", "v.field_name", "v.value", "page").where("value is not null")


def is_placeholder(value: Column) -> Column:
    return value.rlike(_MARKS) & value.rlike(PLACEHOLDER)


def is_filler(form: Column) -> Column:
    """Words of pseudo-Latin, and hardly a letter of anything else."""
    rest = F.length(F.regexp_replace(F.regexp_replace(form, FILLER_WORDS, ""), "[^\\p{L}]", ""))
    return form.rlike("(?<![\\p{L}])(?:lorem|ipsum|dolor|amet|sadipscing|consetetur|elitr?|nonumy|eirmod|invidunt|aliquyam|voluptua|accusam|rebum|dolores|dolore|labore|tempor|diam|justo|takimata|gubergren|eiusmod|incididunt|magna)(?![\\p{L}])") & (
        rest * 5 <= F.length(F.regexp_replace(form, "[^\\p{L}]", ""))
    )


def residue_rules(value: Column) -> Column:
    """The rules on a single value, without recurrence; null for null."""
    # lambda variables, so that each form is made once
    whole = lambda v, judge: F.exists(F.array(_masked(v)), judge)
    listed = lambda w: w.rlike(MESSAGE)
    judged = lambda w: listed(w) | is_filler(w)
    sited = lambda v: whole(F.regexp_replace(v, _SITE, ""), judged) | whole(v, listed)
    worded = F.exists(F.array(_spelled(value)), lambda v: F.when(v.rlike(_SITE), sited(v)).otherwise(whole(v, judged)))
    return is_placeholder(value) | worded


def judged_values(values: DataFrame) -> DataFrame:
    """Of every value what the rules say of it, the hashes of its masked form and of its host, whether its address spells it,
    and the form itself where it still may be a notice."""
    d = computed(values.where(F.length(F.trim("value")) > 0), spelled=_spelled(F.col("value")))
    d = computed(d, whole=_masked(F.col("spelled")), sited=F.col("spelled").rlike(_SITE))
    d = computed(d, form=F.when(F.col("sited"), _masked(F.regexp_replace("spelled", _SITE, ""))).otherwise(F.col("whole")))
    form = F.col("form")
    message = form.rlike(MESSAGE) | (F.col("sited") & F.col("whole").rlike(MESSAGE)) | is_filler(form)
    rule = F.when(is_placeholder(F.col("value")), "placeholder").when(message, "message")
    d = computed(d, rule=rule, tied=tied_to(F.col("spelled"), F.col("page")))
    open_form = F.when(F.col("rule").isNull() & ~F.col("tied"), form)
    return d.select("table_name", "record_id", "field_name", "rule", "tied", F.xxhash64("form").alias("hash"), F.xxhash64(site_of(F.col("page"))).alias("source"), open_form.alias("form"))


def recurring_forms(judged: DataFrame, least_sources: int = LEAST_SOURCES) -> DataFrame:
    """(hash, sources) of the forms that stand on at least ``least_sources`` hosts and that no address spells.

    Forms are counted per host before the hosts are counted, both with map-side combination, so a form that a third of all
    values hold, or a host with a third of all values, is no hot key.
    """
    hosts = judged.groupBy("hash", "source").agg(F.max("tied").alias("tied"))
    return hosts.groupBy("hash").agg(F.count(F.lit(1)).alias("sources"), F.max("tied").alias("tied")).where((F.col("sources") >= least_sources) & ~F.col("tied")).select("hash", "sources")


def find_residue(values: DataFrame, least_sources: int = LEAST_SOURCES) -> DataFrame:
    """(table_name, record_id, field_name, rule) of the values that are no content.

    ``values`` comes from ``values_of``. rule is placeholder, message or recurring. Recurring are forms on
    ``least_sources`` or more hosts that no address spells, as addresses spell headlines, and that are worded like a notice.
    The hosts are counted over all values. Null and empty values, and values of blanks only, are no cases; a null address
    counts as one host; repeated rows are cases of their own. Empty input gives no rows.
    """
    judged = cut_lineage(judged_values(values))
    again = judged.where("form is not null").join(recurring_forms(judged, least_sources), "hash", "left_semi")
    again = computed(again, notice=is_notice(F.col("form"))).where("notice")  # behind the join: a filter would be moved before it
    columns = ["table_name", "record_id", "field_name"]
    return judged.where("rule is not null").select(*columns, "rule").unionByName(again.select(*columns, F.lit("recurring").alias("rule")))
