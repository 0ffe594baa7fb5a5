"""Word lists of the labelers: fixed values."""

#: Common given names.
GIVEN = {
    "en": "anna ruth mabel nora ivy clara tessa helen lionel simon owen rowan martin hugh peter edwin john mary james linda robert susan michael karen david sarah thomas emma george alice henry grace oliver lucy arthur jane edward laura".split(),
    "ru": "илья нина глеб вера матвей ксения тамара тимур софья юлия павел семён семен фёдор федор андрей лев алла дарья анна иван мария пётр ольга сергей елена николай наталья дмитрий татьяна михаил ирина алексей екатерина борис галина".split(),
    "de": "jürgen katrin anke lothar veit jörg ulrike heike bernd hans klaus sabine monika wolfgang petra dieter ursula günter renate stefan andreas claudia uwe birgit".split(),
    "fr": "yvan gérard rémi odile hélène maëlle benoît noémie solange pierre marie jean michel françois isabelle philippe nathalie jacques sylvie alain catherine christophe élodie".split(),
}

#: Digits in words.
NUMBER_WORDS = tuple("zero oh one two three four five six seven eight nine null eins zwei drei vier fünf sechs sieben acht neun zéro un deux trois quatre cinq sept huit neuf ноль один два три четыре пять шесть семь восемь девять".split())

PHONE_CUES = ("phone", "telephone", "tel.", "tel", "tél", "tél.", "тел", "тел.", "телефон", "номер", "звоните", "number is", "call", "mobile", "anrufen", "bitte", "appelez", "appelez le", "or", "или", "oder", "ou")
ID_CUES = ("ssn", "id", "id no", "снилс", "паспорт", "инн", "студенческий", "student no", "student no.", "card", "ausweis", "matr.-nr", "matr.-nr.", "matrikelnummer", "carte", "n° étudiant", "étudiant", "passport", "insurance", "sécu")
ADDRESS_CUES = ("address", "sent to", "lives at", "адресу", "тут", "адрес", "живёт", "adresse", "wohnt", "au", "permanence", "an")
NAME_CUES = ("by", "with", "thank", "scribe", "contact", "contact;", "контакт", "контакт;", "консультации", "sprechstunde", "permanence", "from", "конспект", "mitschrift", "notes de", "so", "так", "тут", "then", "you", "вы", "and", "и", "und", "et", "an", "mr", "mrs", "--", "user")
TITLES = ("prof", "dr", "mr", "mrs", "ms", "miss", "herr", "frau", "dipl", "m", "mme", "mlle", "проф", "доц", "д-р", "г-н", "г-жа", "акад", "professor", "doctor")
NAME_FOLLOWS = ("missed", "asked", "asks", "said", "says", "wrote", "fehlt", "fragt", "fragte", "sagte", "demande", "demanda", "a demandé", "manque", "спрашивает", "спросил", "спросила", "студенческий", "and", "и", "und", "et")

#: Nouns of mathematical results, spaces and methods: a person's name beside one is part of its name.
RESULT_NOUNS = (
    "lemma theorem inequality principle trick space spaces constant constants criterion condition operator norm algorithm conjecture method formula identity proof "
    "satz ungleichung prinzip raum konstante kriterium verfahren beweis "
    "lemme théorème inégalité principe espace astuce critère procédé treillis "
    "лемма леммы лемму лемме теорема теоремы теореме теорему неравенство неравенства принцип трюк пространство пространства константа константы признак критерий метод оператор норма поле поля"
).split()

UNITS = "points? entries steps? ms seconds? minutes? pages? halves rounds? punkte cells?".split()
