"""Default word lists of the profilers. Every operator takes another Lexicon instead; lists are data, not logic.

Fixed values: all lists of this module are plain words in everyday use.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _w(s: str) -> tuple[str, ...]:
    return tuple(sorted(set(s.split())))


@dataclass(frozen=True)
class Lexicon:
    coordinating: tuple[str, ...] = _w("and but or aur lekin par ya")
    subordinating: tuple[str, ...] = _w("because since although if unless while when kyunki agar jab jabki warna")
    interrogative: tuple[str, ...] = _w("what why when where who how which kya kyun kab kahan kaise kaun kitna")
    imperative: tuple[str, ...] = _w("please send give let follow use call check finish dekho batao suno karo bhej chalo bolo")
    negation: tuple[str, ...] = _w("not no never cannot nobody nahi mat na")
    first_person: tuple[str, ...] = _w("i my me mine we us our main mera meri mujhe maine hum")
    second_person: tuple[str, ...] = _w("you your yours tum tumne tumhe tera aap")
    third_person: tuple[str, ...] = _w("he she it they him her his their them woh usne uska unka")
    modal: tuple[str, ...] = _w("can could should would must may might will chahiye hoga hogi karega")
    enclitic: tuple[str, ...] = _w("yaar bhai na arre toh re")
    abbreviation: tuple[str, ...] = _w("pls plz btw idk tbh lol lmao thx msg pic abt okk")
    homograph: tuple[str, ...] = _w("main so the us to par is no in")
    universal: tuple[str, ...] = _w("url email phone forwarded omitted message deleted ok okk lol haha hahaha hmm lmao")
    conditional: tuple[str, ...] = _w("if agar warna")
    when: tuple[str, ...] = ("jab",)
    then: tuple[str, ...] = ("tab",)
    prohibitive: tuple[str, ...] = _w("mat don't dont")
    closing_imperative: tuple[str, ...] = _w("kar karo dekho batao")
    # the commonest words of each language in general, not those of any table
    english: tuple[str, ...] = _w(
        "the be to of and a in that have i it for not on with he as you do at this but his by from they we say her she or an will my one all would there their what so up out if about who get which go me when make can "
        "like time no just him know take people into year your good some could them see other than then now look only come its over think also back after use two how our work first well way even new want because any "
        "these give day most us is are was were been has had did does said went made got am very much more many where why here off again always never still too must should may might let need help call tell ask find "
        "keep put seem leave feel try thing man woman child world life hand part place week case point home water room mother night old great big small long high right left next last same few"
    )
    hindi: tuple[str, ...] = _w(
        "main mera meri mere mujhe mujhko maine hum hamara hamari hamare humein tum tumhara tumhari tumhe tumne aap aapka aapki aapko woh wo uska uski uske usko usne ye yeh iska iski iske isko isne unka unki unke unko inka "
        "kya kyun kyon kab kahan kaise kaisa kaun kisko kiska kitna kitne kitni hai hain tha thi the ho hoon hua hui hue hoga hogi honge gaya gayi gaye raha rahi rahe kar karo karna karke karta karti karte kiya ki ka ke ko se "
        "mein par tak liye saath aur ya lekin magar agar toh bhi hi nahi nahin mat na haan han accha acha theek thik bahut bohot kuch koi sab sabhi kabhi abhi aaj kal parson phir fir jab tab jaise waise aisa waisa yahan wahan "
        "jao jana jaana aao aana aaya dekho dekha suno suna bolo bola bol batao bata lo lena do dena diya liya ghar kaam baat din raat paani khana log dost bhai yaar behen mata pita bacha"
    )
    discourse: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "humor": _w("lol lmao rofl haha hahaha mazak joke"),
            "question": _w("what why when where who how which kya kyun kahan kitna kab kaise"),
            "disagree": _w("nahi nope wrong galat cannot never"),
            "agree": _w("ok okk yes yeah haan accha done sahi cool thanks"),
            "explain": _w("because since kyunki isliye reason"),
            "clarify": _w("matlab actually basically specifically yaani"),
            "hedge": _w("maybe probably shayad almost"),
            "advice": _w("should chahiye please karo let"),
            "emphasis": _w("really totally so bahut absolutely literally"),
        }
    )
    humor_emoji: str = "\U0001f602\U0001f62d\U0001f923\U0001f480"
    technical: tuple[str, ...] = _w("code error version printer laptop password reset server bug build test table query charger line")
    career: tuple[str, ...] = _w("exam class homework assignment deadline resume job interview marks college meeting submit")
    conflict: tuple[str, ...] = _w("nahi wrong galat angry naraaz never nobody broke")
    probing: tuple[str, ...] = _w("what why when where who how which kya kyun kahan kitna batao")
    acknowledgement: tuple[str, ...] = _w("ok okk okay yes haan done cool accha hmm thanks")
    stopwords: tuple[str, ...] = _w("the a an and or but of to in on for is are was be it this that i you we my your me us so with at as by hai ka ki ke ko se mein ho na kya woh tum main par aur")


DEFAULT = Lexicon()

#: Order of acts and situations: ties go to the first.
ACTS = ("agree", "disagree", "question", "explain", "clarify", "hedge", "advice", "humor", "emphasis", "informative")
SITUATIONS = ("acknowledgement", "technical_collab", "career_academic", "conflict_friction", "advice_probing", "casual_banter")
