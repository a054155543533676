"""Plain Python versions of the query contracts, for small inputs."""

import re,hashlib,collections
def sha(s): return hashlib.sha256(s if isinstance(s,bytes) else s.encode()).hexdigest()
def luhn(d):
    s=0
    for i,c in enumerate(reversed(d)):
        n=int(c)
        if i%2: n=n*2-9 if n>4 else n*2
        s+=n
    return s%10==0
def op1(docs):
    out={}
    for i,t in docs:
        t=t or ""
        k=collections.OrderedDict(email=[],ip=[],card=[],phone=[])
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",t): k['email'].append(m.span())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",t):
            if all(int(x)<=255 for x in m.group().split('.')): k['ip'].append(m.span())
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+",t):
            d=re.sub('[^0-9]','',m.group())
            if 13<=len(d)<=19 and luhn(d): k['card'].append(m.span())
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]",t):
            if 9<=len(re.sub('[^0-9]','',m.group()))<=15: k['phone'].append(m.span())
        b=",".join(f"{a}:{s}:{e}" for a,v in k.items() for s,e in v)
        out[i]=(*[len(v) for v in k.values()],sha(b))
    return out
def op8(docs):
    out={}
    for i,t in docs:
        t=t or ""
        sp=[]
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",t,re.I|re.A):
            if len(m.group(2))>=6: sp.append((m.start(),0,m.end(),'assign'))
        for m in re.finditer(r"AKIA[A-Z0-9]+",t):
            if m.end()-m.start()>=20: sp.append((m.start(),1,m.end(),'access'))
        for m in re.finditer(r"[0-9a-f]+",t):
            if m.end()-m.start()>=24: sp.append((m.start(),2,m.end(),'hex'))
        sp.sort()
        n=collections.Counter(x[3] for x in sp)
        out[i]=(n['assign'],n['access'],n['hex'],sha(",".join(f"{k}:{s}:{e}" for s,_,e,k in sp)))
    return out
def op6(docs):
    g=collections.defaultdict(list); nn={}
    for i,t in docs:
        n=re.sub(r"[\x20\x09-\x0D]+"," ",t or ""); nn[i]=n; g[n].append(i)
    return {i:(min(g[n]),len(g[n]),min(g[n])==i,sha(n)) for i,n in nn.items()}
W=re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
def lw(t):
    return W.findall((t or "").translate({c:c+32 for c in range(65,91)}))
def op5(docs,items,N=10):
    win=collections.defaultdict(set)
    for i,t in items:
        w=lw(t)
        if not w: continue
        if len(w)<N: win[tuple(w)].add(i)
        else:
            for s in range(len(w)-N+1): win[tuple(w[s:s+N])].add(i)
    lens=set(map(len,win)); out={}
    for i,t in docs:
        w=lw(t); hit=set(); it=set()
        for L in lens:
            for s in range(len(w)-L+1):
                x=win.get(tuple(w[s:s+L]))
                if x: hit.update(range(s,s+L)); it|=x
        out[i]=(len(w),len(hit),len(it),sha(",".join(sorted(map(str,it)))),len(hit)>0)
    return out
def op9(docs,N=20):
    docs=sorted(docs); first={}; ws={}
    for i,t in docs:
        w=re.findall(r"[^\x20\x09-\x0D]+",t or ""); ws[i]=w
    rem={i:set() for i in ws}
    for i,w in ws.items():
        for s in range(len(w)-N+1):
            k=tuple(w[s:s+N])
            if k in first: rem[i].update(range(s,s+N))
            else: first[k]=(i,s)
    return {i:(len(w),len(rem[i]),sha(" ".join(x for j,x in enumerate(w) if j not in rem[i]))) for i,w in ws.items()}
def op3(docs,N=400):
    c=collections.Counter(); bs={i:(t or "").encode() for i,t in docs}
    for b in bs.values():
        for s in range(len(b)-N+1): c[hash(b[s:s+N])]+=1
    out={}
    for i,b in bs.items():
        m=bytearray(len(b)); 
        for s in range(len(b)-N+1):
            if c[hash(b[s:s+N])]>1: m[s:s+N]=b'\1'*N
        runs=len(re.findall(b'\1+',bytes(m)))
        out[i]=(len(b),sum(m),runs,sha(bytes(x for x,y in zip(b,m) if not y)))
    return out
def op12(rows):
    """rows: (conv_id, turn, role, text). A left-to-right search over the places of the pattern."""
    import zlib
    convs=collections.defaultdict(list); ws="\x20\x09\x0a\x0b\x0c\x0d"
    sp=lambda x: " " if x is None else x
    for c,t,r,x in rows:
        convs[c]; r,x=sp(r),sp(x); f=zlib.crc32(f"{sp(c)}:{sp(t)}".encode())%20
        if f==0: continue
        if f==1: x=""
        if f==2: x=re.sub("[.!?]","",x)
        if f==4: r="user"
        convs[c]+=[(t,r,x)]*(2 if f==3 else 1)
    return {c:op12_repair(v) for c,v in convs.items()}
STEP={(0,"s"):1,(0,"u"):2,(1,"u"):2,(3,"u"):2,(2,"a"):3}
def op12_faults(v):
    seen=set(); out=[]
    for t,r,x in v:
        y=x.strip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not y else "duplicate" if (r,x) in seen else "truncated" if y[-1] not in ".!?" else ""); seen.add((r,x))
    return out
def op12_best(items):
    """items: (initial, fault); least (cost, audit)."""
    best={0:(0,"")}
    def inserts():
        for _ in range(4):
            for p,(c,a) in list(best.items()):
                for x in "ua":
                    q=STEP.get((p,x))
                    if q is not None and (c+2,a+"I")<best.get(q,(10**9,)): best[q]=(c+2,a+"I")
    inserts()
    for i,f in items:
        new={}
        for p,(c,a) in best.items():
            moves=[(p,3,"D")]
            if f not in("blank","duplicate"):
                e=f=="truncated"
                moves+=[(STEP.get((p,i)),e,"K")]+[(STEP.get((p,x)),2+e,"R") for x in "ua"]
            for q,k,l in moves:
                if q is not None and (c+k,a+l)<new.get(q,(10**9,)): new[q]=(c+k,a+l)
        best=new; inserts()
    return min(best[q] for q in (0,3) if q in best)
def op12_repair(v):
    v=sorted(v,key=lambda z:(z[0] is not None,z[0] or 0,z[1]))
    if not v: return (0,0,0,0,0,0,"",sha(""))
    f=op12_faults(v); turns={t for t,_,_ in v if t is not None}
    gaps=max(turns)-min(turns)+1-len(turns) if turns else 0
    ill=sum(a[1][:1]+b[1][:1] not in("su","ua","au") for a,b in zip(v,v[1:]))
    cost,audit=op12_best([(r[:1],k) for (_,r,_),k in zip(v,f)])
    n=len(audit)-audit.count("D"); want=("s" if n%2 else "")+"ua"*(n//2); name={"u":"user","a":"assistant"}
    lines=[]; it=iter(v); j=0
    for l in audit:
        t,r,x=next(it) if l!="I" else (None,"","")
        if l=="D": continue
        lines.append(f"{r if l=='K' else name[want[j]]}:{x}"); j+=1
    return (gaps,f.count("blank"),f.count("duplicate"),f.count("truncated"),ill,cost,audit,sha("\n".join(lines)))
def op13(rows):
    """rows: (vec_id, label, vector)."""
    import math
    pts=set()
    for i,l,v in rows:
        if l is None or v is None or any(x is None or not math.isfinite(x) for x in v): continue
        if i is not None and i%7==0: l=(l+1)%10
        pts.add((i,l,tuple(math.floor(256*x) for x in v)))
    key=lambda z:(-z[0],z[1] is None,z[1] or 0)
    out=[]
    for i,l,v in pts:
        if i is None or i%100: continue
        sc=[(sum(a*b for a,b in zip(v,w)),j,m) for j,m,w in pts]
        pos=sorted([(s,j) for s,j,m in sc if m==l and j!=i],key=key)[:5]
        for ps,j in pos:
            neg=sorted([(s,k) for s,k,m in sc if m!=l and 30*ps<=100*s<=90*ps],key=key)[:10]
            out+=[(i,j,n+1,k,ps,s) for n,(s,k) in enumerate(neg)]
    return sorted(out,key=str)
def op11(rows,weights=(3,1,2)):
    """rows: (doc_id, source, text): sizes, targets by source (as fractions)."""
    from fractions import Fraction
    size=[len(re.findall(r"[^\x20\x09-\x0D]+",t or "")) for _,_,t in rows]
    src=collections.Counter()
    for (_,s,_),n in zip(rows,size): src[s]+=n
    names=sorted(src,key=lambda s:(s is None,(s or "").encode())); w={s:weights[i%3] for i,s in enumerate(names)}
    T=Fraction(3*sum(size),2); clamped=set()
    while True:
        open_=[s for s in names if s not in clamped]
        if not open_: break
        lam=(T-sum(2*src[s] for s in clamped))/sum(w[s] for s in open_)
        more={s for s in open_ if lam*w[s]>2*src[s]}
        if not more: break
        clamped|=more
    return size,src,{s:Fraction(2*src[s]) if s in clamped else lam*w[s] for s in names}
